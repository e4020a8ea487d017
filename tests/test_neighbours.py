import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwake.ml import neighbours as N
from cartwake.ml import training


def brute(rows, k):
    keys, v = [r[0] for r in rows], np.array([r[1] for r in rows])
    out = []
    for i, a in enumerate(keys):
        d = np.sqrt(((v - v[i]) ** 2).sum(axis=1)).round(9)
        best = sorted((float(d[j]), keys[j]) for j in range(len(keys)) if j != i)[:k]
        out += [(a, r, b, x) for r, (x, b) in enumerate(best, 1)]
    return sorted(out)


def cloud(n, width=4, seed=0):
    """Clusters, ties on a grid, and a vector that a third of all rows share."""
    dice = np.random.default_rng(seed)
    v = np.round(dice.normal(size=(n, width)) + dice.integers(0, 6, size=(n, 1)) * 4, 1)
    v[: n // 3] = v[0]
    return [(f"k{i:05d}", [float(x) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize("block,pivots,k", [(4096, 256, 5), (16, 7, 3), (5, 40, 1)])
def test_nearest_equals_brute_force(spark, monkeypatch, block, pivots, k):
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    monkeypatch.setattr(N, "MOST_PIVOTS", pivots)
    rows = cloud(500)
    found = N.nearest(spark.createDataFrame(rows, "key string, v array<double>").repartition(5), k)
    assert sorted(map(tuple, found.select("key", "rank", "neighbour", "distance").collect())) == brute(rows, k)


@pytest.mark.parametrize("rows", [[], [("a", [1.0])], [("a", [1.0]), ("b", [1.0])], [("a", [1.0]), ("b", [3.0]), ("c", [2.0])]])
def test_few_rows(spark, rows):
    found = N.nearest(spark.createDataFrame(rows, "key string, v array<double>"), 5)
    assert sorted(map(tuple, found.select("key", "rank", "neighbour", "distance").collect())) == brute(rows, 5)


def test_far_blocks_are_not_visited(spark, monkeypatch):
    """Ten clusters far apart: no row meets members of another cluster."""
    monkeypatch.setattr(N, "MOST_PIVOTS", 64)
    met = spark.sparkContext.accumulator(0)
    plain = N._distances

    def counted(a, b):
        met.add(len(a) * len(b))
        return plain(a, b)

    monkeypatch.setattr(N, "_distances", counted)
    dice = np.random.default_rng(1)
    rows = [(f"k{i}", (dice.normal(size=3) + 1000 * (i % 10)).tolist()) for i in range(3000)]
    assert N.nearest(spark.createDataFrame(rows, "key string, v array<double>"), 5).count() == 15_000
    # All pairs are nine million; pivots alone are 3000 x 55 twice.
    assert 0 < met.value < 3_000_000


def test_synthetic_rows_lie_between_near_rows(spark):
    dice = np.random.default_rng(2)
    rows = [(f"s{i}", int(i >= 40), float(dice.normal()), float(dice.integers(0, 9))) for i in range(200)]
    df = spark.createDataFrame(rows, "session_id string, abandoned int, a double, b double")
    made = training.synthetic_minority(df, ["a", "b"]).collect()
    few = {r[0]: r[2:] for r in rows if r[1] == 0}
    assert len(made) == 120 and {r.abandoned for r in made} == {0}
    assert {sum(r.session_id == s for r in made) for s in few} == {3}
    scale = np.array(list(few.values())).std(axis=0)
    near = {(a, b) for a, _, b, _ in brute([(s, [x / y for x, y in zip(v, scale)]) for s, v in few.items()], 5)}
    for r in made:
        assert (r.session_id, r.neighbour) in near and 0 <= r.share < 1
        for c, x, y in zip("ab", few[r.session_id], few[r.neighbour]):
            assert abs(r[c] - (x + r.share * (y - x))) < 1e-9
    again = training.synthetic_minority(df.repartition(3), ["a", "b"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, made))


def test_one_row_of_a_class_has_no_neighbour(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("b", 0, 1.0), ("c", 0, 2.0)], "session_id string, abandoned int, a double")
    assert training.synthetic_minority(df, ["a"]).count() == 0
    assert training.synthetic_minority(df.where(F.lit(False)), ["a"]).count() == 0
