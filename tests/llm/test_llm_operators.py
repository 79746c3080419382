"""Brute-force checks of the training-data operators on small, untidy tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakehound.llm import (components, decontam, langid, licenses, linededup, neardup, packing, quality, sharding,
                           toxicity, urlfilter, words)

WORDS = "one two three four five six seven eight nine ten alpha beta gamma delta river stone cloud tree".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"


def _text(rnd, n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 40)) for _ in range(n))


def _rows():
    rnd = random.Random(3)
    base = [_text(rnd, 60) for _ in range(6)]
    out = []
    for i in range(40):
        lines = [rnd.choice(base) if rnd.random() < 0.4 else _text(rnd, rnd.randint(1, 40)) for _ in range(rnd.randint(1, 5))]
        out.append((i, "\n".join(lines), "en" if i % 2 else "de", "s0" if i % 3 else None))
    near = _text(rnd, 80).split(" ")
    for i in range(40, 52):
        near = near.copy()
        near[rnd.randrange(80)] = "changed" + str(i)
        out.append((i, " ".join(near), "en", "s1"))
    out += [(60, None, "en", "s0"), (61, "", None, "s0"), (62, " \t\n", "en", None), (63, "two words", "en", "s0"),
            (64, "12 34 !!", "de", "s0"), (None, out[3][1], "en", "s0"), (None, None, None, None),
            (65, out[5][1], "en", "s0"), (65, out[5][1], "en", "s0"), (66, _text(rnd, 30000), "en", "s0"), (67, "Éa ñb ß \u00a0 x\x1cy", "fr", "s0")]
    return [(d, t, lang, s, None, 9.5) for d, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _shingles(text):
    w = _words(_ascii_lower(text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_url_filter_against_rules(spark):
    urls = ["http://a.example.com/en/1", "https://www.EXAMPLE.com/en/2?x", "http://b.net/fr/", "http://net/es/9#t", "http://com", "http://com/",
            "no scheme", None, "", "http://x.org/en/", "ftp://notexample.com/en/x", "x://a..example.com/en/\u00e9", "http://u/?://net/es/"]
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h")], "page_id long, url string, host string")
    got = urlfilter.judge_urls(pages, spark.createDataFrame(list(rules.items()), "rule string, verdict string")).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        host, path = (_ascii_lower(m[1]), m[2]) if m else ("", "")
        fits = [x for x in rules if (host == x.split("/")[0] or host.endswith("." + x.split("/")[0])) and path.startswith(x[x.index("/"):])]
        best = max(fits, key=len, default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best, rules.get(best, "allow"))
    empty = urlfilter.judge_urls(pages.limit(0), spark.createDataFrame([], "rule string, verdict string"))
    assert empty.count() == 0
    assert {r.verdict for r in urlfilter.judge_urls(pages, spark.createDataFrame([], "rule string, verdict string")).collect()} == {"allow"}


def test_cascade_is_exact_in_shards(spark):
    every = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = every.filter("key like '%7'")
    cascade = urlfilter.build_cascade(listed, every, pass_bits=600)
    assert cascade.shards > 1 and len(cascade.levels) > 1
    got = urlfilter.listed_keys(every.select(F.array("key").alias("keys")), "keys", cascade, "hit", pass_bits=600)
    assert got.filter("hit[0] <> (keys[0] like '%7')").count() == 0


def test_quality_base_measures(docs, none):
    texts = {r.doc_id: r.text for r in docs.filter("doc_id is not null").collect()}
    got = quality.judge_quality(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        text = texts.get(r.doc_id) if r.doc_id is not None else None
        if r.doc_id is None:
            continue
        w = _words(text)
        win = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if win[tuple(w[i:i + 5])] > 1 for k in range(5)}
        lines = [x for x in (text or "").split("\n") if _words(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality.judge_quality(none).count() == 0


def test_boilerplate_depletes_only_its_documents(spark):
    common = "this line stands in very many documents of the host and says nothing at all"
    rows = [(i, f"{common}\nshort own {i}", "h") for i in range(30)] + [(99, "\n".join(" ".join(f"w{k}x{j}" for j in range(12)) for k in range(5)) + "\n" + common, "h")]
    got = {r.doc_id: r.kept for r in quality.judge_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[99] and not any(got[i] for i in range(30))


def test_boilerplate_counts_distinct_documents(spark):
    """Copies under other doc_ids count for a line, rows that repeat a doc_id do not."""
    def text(k):
        return f"the very same line of {k} in each of these documents and nothing else here"

    rows = [(i, text("copies"), "h", 1) for i in range(21)] + [(100, text("repeats"), "h", 1)] * 30 + [(200 + i, text("few"), "h", 1) for i in range(20)]
    rows += [(300 + i, text("hosts"), f"h{i % 2}", 1) for i in range(40)] + [(None, text("nameless"), "h", 1)] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, line int").repartition(4)
    got = quality.judge_quality(docs).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if not r.kept} == set(range(21))


def _dedup_brute(rows):
    key = lambda x: _ascii_lower(x.strip(" \t\n\v\f\r"))
    holders = defaultdict(set)
    for d, t in rows:
        if d is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= 20:
                    holders[key(x)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if d is None or len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_dedup_and_reversal(spark, docs, none):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, linededup.line_dedup_digest(docs).collect()), key=str) == _dedup_brute(rows)
    assert linededup.dedup_lines(none).count() == 0
    first, more = docs.filter("doc_id < 20"), docs.filter("doc_id >= 20")
    index = linededup.LineIndex.build(first).insert(more)
    whole = linededup.LineIndex.build(docs)
    as_set = lambda x: set(map(tuple, x.counts.collect()))
    assert as_set(index) == as_set(whole)
    back = index.delete(more.select("doc_id"))
    assert as_set(back) == as_set(linededup.LineIndex.build(first))
    with_index = linededup.dedup_lines(first, back).select("doc_id", "n_dropped", F.sha2("text", 256).alias("h"))
    assert set(map(tuple, with_index.collect())) == {(d, n, h) for d, _, n, h in _dedup_brute([x for x in rows if x[0] is not None and x[0] < 20])}


def test_cuckoo_keeps_all_and_forgets():
    keys = np.random.default_rng(1).integers(0, 2**63, (4000, 2)).astype(np.uint64)
    own = linededup.Cuckoo.sized(4000)
    assert own.insert(keys) and own.contains(keys).all()
    own.remove(keys)
    assert not own.table.any()


def _components_brute(rows, percent=85):
    sets = [_shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return sorted(((d, len(sets[i]), best.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("size", [1 << 19, 300])
def test_near_duplicates(docs, size):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = neardup.near_duplicates(docs, task_shingles=size).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _components_brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_nothing(none):
    assert neardup.near_duplicates(none).count() == 0


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    sets = [a, np.append(a[:380], rng.integers(0, 2**63, 20).astype(np.uint64)), a[:1]]
    got = neardup.sketches(np.concatenate(sets), np.repeat([0, 1, 2], [400, 400, 1]), 3)
    assert (got != neardup._EMPTY).all()
    assert abs((got[0] == got[1]).mean() - 380 / 420) < 0.12


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (5, 6), (7, 7), (6, 5)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5}
    chain = spark.range(300).select("id", (F.col("id") + 1).alias("v")).toDF("u", "v")
    assert components.components(chain).filter("component <> 0").count() == 0


def test_packing_round_trip(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        want[(r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    pieces = packing.pack(docs, path).collect()
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    at = 0
    for s, o, n in places:
        assert s * packing.LENGTH + o == at and o + n <= packing.LENGTH
        at += n
    assert at == sum(n * k for (_, n, _), k in want.items())
    whole = [p for p in pieces if p.length == p.doc_tokens]
    assert all((p.doc_id, p.doc_tokens, p.ids_crc32) in want for p in whole)
    by = defaultdict(int)
    for p in pieces:
        by[p.doc_id] += p.length
    assert all(by[d] == sum(n * k for (e, n, _), k in want.items() if e == d) for d in by)
    assert packing.pack(none, path).count() == 0


def test_pieces_equal_the_tokenizer():
    own = packing.Pieces(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(5)
    parts = ["a", "B", "é", " ", "  ", "\n", "\t", "'s", "'", "1", "½", "...", "$", "\u00a0", "\u3000", "<|endoftext|>", "\x1c", "\x85", "日本", "the", "\r\n", "\x00"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(600)]
    ids, first = own.ids(words.flat(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[first[i]:first[i + 1]].tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids


def test_hilbert_steps_are_neighbours():
    points = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    order = points[np.argsort(packing.hilbert(points, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def _jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_sharding(docs, none):
    keys = np.random.default_rng(4).integers(0, 2**63, 500).astype(np.uint64)
    for n in (1, 8, 9):
        assert sharding.jump(keys, n).tolist() == [_jump(int(k), n) for k in keys]
    got = sharding.shard_documents(docs).collect()
    texts = {(r.doc_id, zlib.crc32((r.text or "").encode())): r.text for r in docs.collect()}
    assert len(got) == docs.count()
    slots = defaultdict(list)
    for r in got:
        assert r.size == len((texts[r.doc_id, r.text_crc32] or "").encode()) + 1
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard_documents(none).count() == 0


def test_language(spark):
    rnd = random.Random(7)
    makers = {"aa": "ba be bi bo".split(), "bb": "xy xo xu zo zu".split()}
    rows = [(i, " ".join("".join(rnd.choice(makers[x]) for _ in range(3)) for _ in range(60)), x) for i in range(90) for x in [("aa", "bb")[i % 2]]]
    rows += [(200, None, "aa"), (201, "", "aa"), (202, "12 ?!", "bb"), (None, "bababe bobi", "aa"), (203, "xyxo zuzo", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert all(got[i].lang_pred == x for i, _, x in rows[:90])
    assert [got[k].lang_pred for k in (200, 201, 202, None, 203)] == ["und", "und", "und", "aa", "bb"]
    assert all(0 <= r.score <= 1 and r.held_out == (k is not None and zlib.crc32(str(k).encode()) % 3 == 1) for k, r in got.items())
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_phrases_are_longest_matches():
    sample, text = b"abracadabra banana", "abra cadabra bandana"
    parser = langid.Parser.of({"x": sample})
    phrases, _ = parser.phrases(words.flat(pa.array([text])))
    known, n, at = sample.decode(), 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in known:
            end += 1
        at, n = max(end - 1, at + 1), n + 1
    assert phrases[0, 0] == n


def test_decontamination(spark, docs, none):
    rnd = random.Random(9)
    items = [(k, _text(rnd, rnd.randint(16, 50))) for k in range(12)] + [(50, "just three words"), (51, None), (52, "")]
    w = items[2][1].split(" ")
    w[len(w) // 2] = "other"
    rows = [(1000, "intro " + items[0][1].upper() + " end"), (1001, _text(rnd, 300) + "\n" + items[1][1].replace(" ", ", ")), (1002, " ".join(w)),
            (1003, "I say just three words here"), (1004, items[3][1][:60]), (None, items[4][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    for passes in (1 << 24, 400):
        got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(planted.unionByName(docs.select("doc_id", "text")), bench, pass_bytes=passes).collect()}
        want = {(1000, 0), (1001, 1), (1003, 50), (None, 4)}
        assert want <= got and got - want <= {(1002, 2)}
        n = len(w) - 4
        assert ((1002, 2) in got) == ((n - 5) / (n + 5) >= 0.8)
    assert decontam.find_leaks(none, bench).count() == 0 and decontam.find_leaks(docs, bench.limit(0)).count() == 0


def test_hamming_index_finds_all_within_radius():
    rng = np.random.default_rng(6)
    prints = rng.integers(0, 2**63, 300).astype(np.uint64)
    index = decontam.HammingIndex(prints, 20)
    for value in rng.integers(0, 2**63, 50).astype(np.uint64):
        assert set(index.near(value)) == set(np.flatnonzero(np.bitwise_count(prints ^ value) <= 20))
    flipped = prints[7] ^ np.uint64(0b10110111 << 20)
    assert 7 in index.near(flipped)


def test_licenses(spark, none):
    mit = dict(((a, b), t) for a, b, t in licenses.TEMPLATES)["MIT", "permission"]
    cut = mit.replace("free of charge", "at no cost")
    rows = [(1, "x y\nReleased under the MIT License.\nmore the under text " * 3), (2, "head " + cut + " tail"), (3, "the software is under the license"), (4, None), (5, "")]
    got = licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.license, r.template) for r in got) == Counter({(1, "MIT", "notice"): 3, (2, "MIT", "permission"): 1})
    assert 0.9 < next(r.coverage for r in got if r.doc_id == 2) < 1
    assert licenses.find_licenses(none).count() == 0


def test_alignment_rises():
    pairs = licenses.align([1, 2, 3, 9, 4, 4, 5], [1, 3, 2, 4, 5, 4])
    assert all(x < y for p, q in zip(pairs, pairs[1:]) for x, y in zip(p, q)) and len(pairs) >= 4


def test_toxicity_learns_on_held_out(spark):
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        w = [rnd.choice(WORDS) for _ in range(60)]
        for _ in range(3 if toxic else 0):
            w[rnd.randrange(60)] = rnd.choice(["vileword", "nastyword", "awfulword"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (None, "vileword")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.score_toxicity(docs, spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")).collect()
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.9 * len(held)
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert toxicity.score_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).filter("score <> 0").count() == 0


def test_toxicity_counts_do_not_saturate(spark):
    rows = [(i, f"ctx{i % 1500} very good w{i % 900}") for i in range(2000)] + [(2000, None), (2001, ""), (2002, "very"), (2003, "good very")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = defaultdict(set)
    for _, t in rows:
        for a, b in zip(["", *(t or "").split()], (t or "").split()):
            before[b].add(a)

    def value(word):
        return int(toxicity._tokens(words.flat(pa.array([word])))[0].view(np.int32)[0])

    got = {r.w: r.ways for r in toxicity.continuations(docs).collect()}
    assert got == {value(w): len(u) for w, u in before.items()}
    assert len(before["very"]) == 1502
    # in both classes "good" always follows "very", after 1400 and after 600 different words
    sample = spark.createDataFrame([(i, int(i >= 1400)) for i in range(2000)], "doc_id long, toxic int")
    model = toxicity.train(docs, sample)
    spot = np.flatnonzero(model.pairs == (np.uint64(value("very") & 0xFFFFFFFF) << np.uint64(32) | np.uint64(value("good") & 0xFFFFFFFF)))
    assert len(spot) == 1 and (model.direct[:, spot] > 0.99).all()
    # bigrams seen once are kept, and what a context's bigrams leave is its discount
    assert len(model.pairs) == 1500 + 1 + 900
    assert (model.back > 0).all() and (model.single > 0).all()


def test_language_learns_from_whole_different_texts(spark):
    rnd = random.Random(11)

    def body(own, n):
        return " ".join(rnd.choice(own) + rnd.choice(own) for _ in range(n))

    header = "shared terms of use " * 80
    rows = [(i, header + f"mark{i:03d}x " + body(["ba", "be", "bi"], 300), "aa") for i in range(40)]
    rows += [(100 + i, header + body(["xy", "xo", "zu"], 300), "bb") for i in range(40)]
    rows += [(1000 + i, "copycopy " * 60, "aa") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = langid.learn(docs)
    assert all(len(x) <= langid.SAMPLE_BYTES for x in got.values())
    # the part after the header is learnt from, and copies count once
    assert got["aa"].count(b"ba") > 500 and got["bb"].count(b"xy") > 500
    assert got["aa"].count(b"copycopy") <= 60
    # every chosen document contributes, and a cut text gives whole characters from all of its length
    assert langid._shares([10, 1000, 2000, 5], 415) == [10, 200, 200, 5]
    long = "".join(f"{i:04d}\u00e9" for i in range(3000))
    some = langid._pieces(long.encode(), 2000).decode()
    found = [int(x) for x in re.findall(r"(?<!\d)\d{4}(?=\u00e9)", some)]
    assert len(some.encode()) <= 2000 and min(found) < 600 and max(found) > 2400
