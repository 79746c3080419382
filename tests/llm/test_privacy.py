"""Op 13: base spans against plain patterns, decoding against plain Viterbi, the field on held-out lines."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakehound.llm import privacy as P
from lakehound.llm import words as W

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _good(kind, match):
    digits = re.sub(r"[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def _brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if _good(k, m.group())]


def _text(rows):
    raw = [r.encode() for r in rows]
    return W.Text(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64))


def _base(rows):
    text = _text(rows)
    before = np.append(0, np.cumsum((text.data & 0xC0) != 0x80))
    return P._written(text.rows, P.base_spans(text), before, text.offsets)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["@", ".", "+", "-", " ", "(", ")", "1", "22", "255", "256", "007", "a", "é", "漢", "\n", "%", "x@y.z",
                                          "4111111111111111", "+1 (274) 555-1898", "10.0.0.1", "4111 1111 1111 1111", "a.b+c", "1234567"]),
                         max_size=14).map("".join), max_size=4))
def test_base_spans_against_patterns(rows):
    assert _base(rows) == [",".join(_brute(r)) for r in rows]


def test_base_spans_of_long_runs_take_linear_time():
    rows = ["a" * 300_000, "1" * 300_000, "1." * 150_000, "1 " * 150_000, "+1" + " " * 300_000, "a@" * 100_000, "@" * 100_000, "a@b." * 60_000]
    got = _base(rows)
    assert got[0] == got[4] == got[6] == "" and got[2].startswith("ip:0:7,ip:8:15")


@pytest.fixture(scope="module")
def field(spark):
    return P.fitted(P.labelled_table(spark))


def _plain_labels(field, rows):
    """Viterbi step by step over whole texts."""
    t = P.tokens(_text(rows))
    features, scores = field.features(t), np.zeros((len(t.code), len(P.LABELS)))
    for i, row in enumerate(t.at.row):
        for place in range(-P.REACH, P.REACH + 1):
            if 0 <= i + place < len(t.at.row) and t.at.row[i + place] == row:
                scores[i] += sum(field.unary[place + P.REACH][f[i + place]] for f in features)
    out = []
    for i in range(len(rows)):
        own = scores[t.at.first[i]:t.at.first[i + 1]]
        if not len(own):
            continue
        best, back = own[0] + field.ends[0], []
        for s in own[1:]:
            ways = best[:, None] + field.pairs
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + s
        label = [int((best + field.ends[1]).argmax())]
        for b in reversed(back):
            label.append(int(b[label[-1]]))
        out += reversed(label)
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_decoding_against_plain_viterbi(spark, field, weak):
    rnd = random.Random(1)
    rows = [" ".join(P._value(rnd, rnd.choice([*P.KINDS, "n", "x", "x", "x", "x"])) for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    rows += ["", "x", " ".join("+1 274 555-1898 4111111111111111" for _ in range(500))]
    if weak:  # other weights, where hardly a token is certain
        noise = np.random.default_rng(4)
        field = P.Field(field.shapes, field.known, noise.normal(0, 0.3, field.unary.shape), noise.normal(0, 1, field.pairs.shape), noise.normal(0, 1, field.ends.shape))
    assert field.decode(P.tokens(_text(rows))).tolist() == _plain_labels(field, rows)


def test_field_on_other_lines(spark, field, monkeypatch):
    """Lines of another seed: spans found whole, and none in lines without personal data."""
    monkeypatch.setattr(P.random, "Random", lambda seed, own=random.Random: own(seed + 1))
    lines = [(r.text, [(s.kind, s.start, s.end) for s in r.spans]) for r in P.labelled_table(spark, 4).collect()]
    found = wrong = want = 0
    for text, spans in lines:
        kinds, _, start, end = P.field_spans(_text([text]), field)
        before = np.append(0, np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80))
        got = {(P.KINDS[k], int(before[a]), int(before[b])) for k, a, b in zip(kinds, start, end, strict=True)}
        # a run of two values of one kind is one span
        covered = {s for s in spans if any(g[0] == s[0] and g[1] <= s[1] + 1 and s[2] <= g[2] + 1 for g in got)}
        want, found = want + len(spans), found + len(covered)
        wrong += any(not any(g[1] < e and s < g[2] for _, s, e in spans) for g in got)
    assert found > 0.95 * want and wrong < 0.02 * len(lines), (found, want, wrong, len(lines))


def test_rows(spark, field):
    texts = [None, "", "née a.b@mail.example.com, x", "call +1 (274) 555-1898 4111111111111111 10.0.0.1 now", "the river and the stone", "\n",
             "word " * 40_000 + "10.0.0.1 " + "a@b.cd", "password=45bb0d53635bf1b89d of", "the river and the stone"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, texts[2]), (None, texts[3])]
    docs = spark.createDataFrame([(d, t, "s", 1) for d, t in rows], "doc_id long, text string, spans string, n_ip int").repartition(2)
    got = P.find_private(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((d is None, d or 0) for d, _ in rows)
    for r in got:
        text = texts[r.doc_id if r.doc_id is not None else 3]
        base = _brute(text)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b.startswith(k + ":") for b in base) for k in PATTERNS)
        assert set(base) <= set(r.spans.split(",")) or not base
    by = {r.doc_id: r.spans for r in got}
    assert by[None] == by[3] == "ip:40:48,card:23:39,phone:5:22" and not _brute(texts[3])[1:]
    assert by[7] == "secret:9:27" and by[4] == by[8] == by[0] == ""


def test_no_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert P.find_private(none).count() == 0
    empty = spark.createDataFrame([], "text string, spans array<struct<kind: string, start: int, end: int>>")
    one = spark.createDataFrame([(1, "a@b.cd 4111111111111111 10.0.0.1")], "doc_id long, text string")
    assert P.find_private(one, empty).first().spans == "email:0:6,ip:24:32"
