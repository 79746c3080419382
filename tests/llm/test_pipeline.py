"""The pipeline's stages against brute force on the smallest tables."""

import random
import re

import corpus_pipeline
from lakehound.llm import decontam

SF = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    one = stages["language_id"](spark, docs, SF).cache()
    assert {r.doc_id for r in one.collect()} == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    two = stages["line_dedup"](spark, one, SF).cache()
    assert two.columns == docs.columns and two.count() == one.count()
    three = stages["near_dedup"](spark, two, SF).cache()
    kept, _ = _four_fifths([(r.doc_id, r.text) for r in two.collect()])
    assert {r.doc_id for r in three.collect()} == kept
    four = stages["decontamination"](spark, three, SF).cache()
    items = [re.findall(r"[a-z0-9]+", r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in three.collect() if any(" " + " ".join(i) + " " in " " + " ".join(re.findall(r"[^\W_]+", r.text.lower())) + " " for i in items)}
    left = {r.doc_id for r in four.collect()}
    assert left <= kept - holds
    leaks = {r.doc_id for r in decontam.find_leaks(three, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert left == kept - leaks
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == left


def _four_fifths(rows):
    """The doc_ids that stay of (doc_id, text) by all pairs at similarity 0.8, and the number of pairs from 0.80 to under 0.85."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in rows]
    sets = [{tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set() for w in words]
    root, between = list(range(len(rows))), 0
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - both
            between += 80 * union <= 100 * both < 85 * union
            if both and 100 * both >= 80 * union:
                root = [root[b] if r == root[a] else r for r in root]
    least = {}
    for (d, _), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, d), d)
    return set(least.values()), between


def test_near_dedup_from_four_fifths(spark):
    rnd = random.Random(80)
    rows = []
    for group in range(25):
        base = [f"w{group}x{i}" for i in range(200)]
        for changed in range(8):
            copy = base.copy()
            for at in range(changed):
                copy[10 + 25 * at + rnd.randrange(5)] = f"new{group}x{changed}x{at}"
            rows.append((8 * group + changed, " ".join(copy)))
    # with 0 and 4 changed words only: what stays hangs on pairs of similarity 0.815 alone
    for some in (rows, [r for r in rows if r[0] % 4 == 0]):
        docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in some], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        want, between = _four_fifths(some)
        assert between >= 25
        assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()} == want
    assert want == {8 * group for group in range(25)}


def test_pipeline_drops_from_four_fifths(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    stages = dict(corpus_pipeline.STAGES)
    lines = stages["line_dedup"](spark, stages["language_id"](spark, docs, SF), SF).cache()
    kept, between = _four_fifths([(r.doc_id, r.text) for r in lines.collect()])
    near = stages["near_dedup"](spark, lines, SF).cache()
    assert between and {r.doc_id for r in near.collect()} == kept
    leaks = {r.doc_id for r in decontam.find_leaks(near, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    left = {r.doc_id for r in stages["decontamination"](spark, near, SF).collect()}
    assert left == kept - leaks
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == left
