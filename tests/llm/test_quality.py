import zlib

import numpy as np

from cartwake.llm import quality as Q
from cartwake.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def test_query_learns_and_holds_out(spark):
    rows = {r.doc_id: r for r in QUERIES["op3_quality"](spark, MIDDLE).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(rows[d].score, q) for d, q in labels.items() if rows[d].held_out]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97
    assert np.mean([s >= 0.7 for s in good]) > 0.9 and np.mean([s < 0.7 for s in bad]) > 0.9


def test_labels_of_held_out_rows_do_not_matter(spark):
    """Nor do lang, source and ids beyond the split: shuffled values give the same model."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.train(docs, labels), Q.train(docs.withColumn("source", F.lit("x")).drop("lang"), flipped)
    assert np.array_equal(a.weights, b.weights) and (a.bias, a.slope, a.offset) == (b.bias, b.slope, b.offset)


def test_features_are_a_set_by_brute_force():
    def brute(text):
        raw, out = text.encode(), set()
        m = 2**32 - 1
        put = lambda g: out.add((g * 0x9E3779B1 & m) >> 14)
        for i in range(len(raw) - 2):
            put(raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2])
        h = [zlib.crc32(w) for w in raw.split()]
        for x in h:
            put(x ^ 0x5BD1E995)
        for x, y in zip(h, h[1:]):
            put((7 if x == y else (x * 0x85EBCA6B & m) ^ y) * 0xC2B2AE35 & m)
        if any(x == y == z for x, y, z in zip(h, h[1:], h[2:])):
            put(8 * 0xC2B2AE35 & m)
        return sorted(out)

    for text in ("", "a", "ab cd", "no no no yes", "é ü", " ".join(f"w{i}" for i in range(3000))):
        assert Q.features(text).tolist() == brute(text)


def test_hinge_model_separates_and_matches_a_small_solver():
    rng = np.random.default_rng(0)
    ratio = np.ones(6)
    rows = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(60)]
    y = np.array([1.0 if 0 in r else -1.0 for r in rows])
    w, bias = Q.fit_hinge(rows, y, ratio, np.full(60, 100.0), rounds=400)
    assert all(np.sign(w[r].sum() / np.sqrt(len(r) + 300) + bias) == t for r, t in zip(rows, y))
    # The primal value is near the one a plain subgradient search finds.
    x = np.zeros((60, 7))
    for i, r in enumerate(rows):
        x[i, r] = 1 / np.sqrt(len(r) + 300)
        x[i, 6] = 1

    def loss(v):
        return 0.5 * v @ v + 100 * np.maximum(0, 1 - y * (x @ v)).sum()

    v, best = np.zeros(7), np.inf
    for t in range(1, 20000):
        v -= (v - 100 * (y * (y * (x @ v) < 1)) @ x) / (t + 10)
        best = min(best, loss(v))
    assert loss(np.append(w, bias)) <= best * 1.01


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (2, 0, None), (3, None, None), (None, 1, 1), (5, 7, 0)], "doc_id long, quality int, toxic int"
    )
    model = Q.train(odd, labels)
    got = Q.score(odd, model)
    assert got.columns == [c for c in odd.columns if c != "score"] + ["score"]
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert Q.score(none, model).count() == 0
    # Nothing to learn from: one score for all.
    empty = Q.train(odd, labels.limit(0))
    assert {r.score for r in Q.score(odd, empty).collect()} == {0.5}
    one = Q.train(odd, labels.where("quality = 1"))
    assert len({r.score for r in Q.score(odd, one).collect()}) == 1
    assert Q.train(none, labels).score("x") == 0.5
