"""Second-order trees against a plain loop over rows."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from cartwake.layout import profile_sessions
from cartwake.ml import boosting as B
from cartwake.ml import metrics

COLUMNS = ["a", "b", "c", "d"]


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, "session_id string, abandoned int, a double, b double, c double, d double").repartition(parts)


def some_rows(n=300, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.randint(0, 9) / 2, rng.randint(-3, 3) * 1.0, float(rng.randint(0, 1))
        y = int(a + b * c + rng.random() > 2.2)
        out.append((f"s{i}", y, a, b, c, 7.0))
    return out


def plain(rows, s):
    """Row by row: every value of every column is tried as a cut, sums are made anew for each."""
    pos = sum(r[1] for r in rows)
    weight = [(len(rows) - pos) / pos if r[1] else 1.0 for r in rows]
    margin = [0.0] * len(rows)
    for t in range(s.trees):
        part = lambda text: hashlib.md5(text.encode()).hexdigest()
        sees = [int(part(f"{s.seed}:{t}:{r[0]}")[:8], 16) < int(s.row_share * 2**32) for r in rows]
        names = sorted(COLUMNS, key=lambda c: part(f"{s.seed}:{t}:{c}"))[: max(1, int(s.column_share * len(COLUMNS)))]
        used = sorted(COLUMNS.index(c) for c in names)
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g = [round((p[i] - r[1]) * weight[i] * 2**24) for i, r in enumerate(rows)]
        h = [round(p[i] * (1 - p[i]) * weight[i] * 2**24) for i in range(len(rows))]

        def gain_of(members):
            gs, hs = (sum(v[i] for i in members) / 2**24 for v in (g, h))
            return gs * gs / (hs + s.shrink), gs, hs

        def grow(members, depth):
            seen = [i for i in members if sees[i]]
            whole, gs, hs = gain_of(seen)
            best = None
            for c in used if depth < s.depth else ():
                for cut in sorted({rows[i][2 + c] for i in range(len(rows))}):
                    low, top = gain_of([i for i in seen if rows[i][2 + c] < cut]), gain_of([i for i in seen if rows[i][2 + c] >= cut])
                    if min(low[2], top[2]) >= s.least_curvature and (best is None or low[0] + top[0] - whole > best[0] + 1e-12):
                        best = (low[0] + top[0] - whole, c, cut)
            if best is None or best[0] <= 1e-6:
                for i in members:
                    margin[i] += -gs / (hs + s.shrink) * s.rate
            else:
                grow([i for i in members if rows[i][2 + best[1]] < best[2]], depth + 1)
                grow([i for i in members if rows[i][2 + best[1]] >= best[2]], depth + 1)

        grow(list(range(len(rows))), 0)
    return {r[0]: 1 / (1 + math.exp(-m)) for r, m in zip(rows, margin)}


@pytest.mark.parametrize("trees, depth, row_share, column_share", [(1, 1, 1.0, 1.0), (4, 3, 0.8, 0.8), (12, 2, 0.6, 0.5)])
def test_probabilities_equal_a_plain_loop(spark, trees, depth, row_share, column_share):
    # The last case writes the margins once on the way.
    rows = some_rows()
    s = B.Settings(trees=trees, depth=depth, rate=0.3, row_share=row_share, column_share=column_share)
    df = table(spark, rows)
    got = {r.session_id: r.probability for r in B.fit(df, COLUMNS, settings=s).score(df, ("session_id",)).collect()}
    want = plain(rows, s)
    assert got.keys() == want.keys() and len(set(got.values())) > 1
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_partitions_do_not_matter_and_a_saved_model_is_the_same(spark, tmp_path):
    rows, s = some_rows(200, 9), B.Settings(trees=3, depth=3, rate=0.5)
    one, many = (B.fit(table(spark, rows, n), COLUMNS, settings=s) for n in (1, 7))
    one.save(spark, str(tmp_path / "trees"))
    again = B.Booster.load(spark, str(tmp_path / "trees"))
    df = table(spark, rows)
    scores = [sorted(map(tuple, m.score(df, ("session_id",)).collect())) for m in (one, many, again)]
    assert scores[0] == scores[1] == scores[2]
    assert again.columns == COLUMNS and again.cuts == one.cuts and len(again.trees) == 3


def test_learns(spark):
    df = table(spark, some_rows(600))
    model = B.fit(df, COLUMNS, settings=B.Settings(trees=20, depth=3, rate=0.3))
    fresh = table(spark, some_rows(400, 77))
    scored = model.score(fresh, ("session_id", "abandoned"))
    assert metrics.ranking(scored, "probability").first()["auc_roc"] > 0.95


def test_quantiles_when_there_are_more_values_than_bins(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("k"))
    cuts = B.find_cuts(df, ["x", "k"], 8)
    assert cuts == [[124.0, 249.0, 374.0, 499.0, 624.0, 749.0, 874.0], []]


def test_odd_rows(spark):
    s = B.Settings(trees=2, depth=2, rate=0.3)
    rows = [(f"s{i % 30}", i % 2, float(i % 2), None, float("nan"), 1.0) for i in range(60)]
    rows += [(None, 1, 1.0, 0.0, 0.0, 1.0), ("x", None, 1.0, 1.0, 1.0, 1.0), ("y", 3, 0.0, 0.0, 0.0, 0.0)]
    df = table(spark, rows).withColumn("a.b", F.lit(1)).withColumn("Probability ", F.lit(2)).withColumn("_x0", F.lit("t"))
    model = B.fit(df, COLUMNS, settings=s)
    got = model.score(df, ("session_id", "a.b", "_x0", "abandoned")).collect()
    assert len(got) == 63 and all(0 < r.probability < 1 for r in got)
    high, low = ([r.probability for r in got if r.abandoned == y] for y in (1, 0))
    assert min(high) > max(low)
    # No rows, and one class alone.
    none = B.fit(df.limit(0), COLUMNS, settings=s)
    assert {r.probability for r in none.score(df, ("session_id",)).collect()} == {0.5}
    ones = B.fit(df.where("abandoned = 1"), COLUMNS, settings=s)
    assert len({r.probability for r in ones.score(df, ("session_id",)).collect()}) == 1
    assert model.score(df.limit(0), ("session_id",)).count() == 0


def test_cuts_are_exact_at_many_rows(spark, monkeypatch):
    n, bins = 120_011, 16
    rows = spark.range(n).select(
        (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 7.0).alias("wide"), (F.col("id") % 11).alias("few"),
        F.when(F.col("id") % 5 > 0, F.lit(-0.0)).otherwise(F.col("id")).alias("zeros"), F.lit(3).alias("one"),
    ).repartition(8)
    want = []
    for c in rows.columns:
        values = sorted(r[0] for r in rows.select(F.col(c).cast("double")).collect())
        want.append(sorted({values[-(-i * n // bins) - 1] for i in range(1, bins)} - {values[0]}))
    assert B.find_cuts(rows, rows.columns, bins) == want
    ranges = lambda df, **k: profile_sessions(df, 1000, 500, 1.0, **k)
    monkeypatch.setattr(B, "profile_sessions", ranges)
    assert B.find_cuts(rows, rows.columns, bins) == want
    assert B.find_cuts(rows.limit(0), rows.columns, bins) == [[], [], [], []]
