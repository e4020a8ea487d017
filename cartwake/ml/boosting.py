"""Second-order boosted trees for two classes, from one histogram aggregate per level.

Columns are cut into bins once.  A level of a tree is one pass: each task adds up the
gradients and curvatures of its rows per (node, column, bin), Spark adds up the tasks, and
the driver sees at most 2^depth * columns * bins sums, whatever the number of rows.  Sums
are whole numbers in units of 2^-24, so a tree does not depend on how rows are cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.layout import profile_sessions
from cartwake.sources.files import stored

UNITS = float(1 << 24)
#: Trees between two writes of the margins; later trees are added up while rows are read.
REFRESH = 10
#: Least gain that a split must bring.
LEAST_GAIN = 1e-6
NODES = "tree int, node int, column string, cut double, value double"


@dataclass(frozen=True)
class Settings:
    trees: int = S.BOOSTING["maxIter"]
    depth: int = S.BOOSTING["maxDepth"]
    rate: float = S.BOOSTING["stepSize"]
    row_share: float = S.BOOSTING["subsamplingRate"]
    column_share: float = float(S.BOOSTING["featureSubsetStrategy"])
    bins: int = 256
    #: Added to the curvature of a leaf.
    shrink: float = 1.0
    #: Least curvature of each side of a split.
    least_curvature: float = 1.0
    seed: int = S.SEED


@dataclass
class Tree:
    """Nodes in heap order: the children of i are 2i+1 (below the cut) and 2i+2."""

    column: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @staticmethod
    def of_depth(depth: int) -> Tree:
        n = (2 << depth) - 1
        return Tree(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row of bins ends."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while (self.column[at] >= 0).any():
            c = self.column[at]
            right = bins[rows, c] > self.bin[at]
            at = np.where(c >= 0, 2 * at + 1 + right, at)
        return at


@dataclass
class Booster:
    """Fitted trees; ``cuts`` are the ascending lower ends of all bins but the first."""

    columns: list[str]
    cuts: list[list[float]]
    trees: list[Tree] = field(default_factory=list)

    def margins(self, values: np.ndarray) -> np.ndarray:
        bins = np.stack([np.searchsorted(c, v, side="right") for c, v in zip(self.cuts, values.T)], axis=1)
        out = np.zeros(len(values))
        for t in self.trees:
            out += t.value[t.nodes(bins)]
        return out

    def score(self, rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        """``keep`` and ``probability``; null and NaN count as zero, as in the fit."""
        # Names of the user's may hold dots, which mapInArrow does not take: numbers stand in.
        kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
        ready = rows.select(*kept, F.array(*[_number(c) for c in self.columns]).alias("x"))
        schema = ready.select(*ready.columns[:-1]).schema.add("probability", "double")
        shared = rows.sparkSession.sparkContext.broadcast(self)  # trees * 2^(depth+1) nodes

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = 1 / (1 + np.exp(-shared.value.margins(_matrix(b, "x"))))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found)], schema.names)

        return ready.mapInArrow(work, schema).toDF(*keep, "probability")

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per node, inner ones with a cut, and one per cut (tree -1, node its place)."""
        rows = [(-1, i, c, v, None) for c, cuts in zip(self.columns, self.cuts) for i, v in enumerate([None, *cuts])]
        for t, tree in enumerate(self.trees):
            rows += [
                (t, n, self.columns[c], self.cuts[c][tree.bin[n]], None) if c >= 0 else (t, n, None, None, float(tree.value[n]))
                for n, c in enumerate(tree.column.tolist())
            ]
        spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], NODES + ", place int").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Booster:
        rows = spark.read.schema(NODES + ", place int").parquet(path).orderBy("place").collect()  # the model
        heads = [r for r in rows if r.tree < 0]
        columns = list(dict.fromkeys(r.column for r in heads))
        out = Booster(columns, [[r.cut for r in heads if r.column == c and r.cut is not None] for c in columns])
        for t in range(1 + max((r.tree for r in rows), default=-1)):
            nodes = [r for r in rows if r.tree == t]
            tree = Tree(np.full(len(nodes), -1), np.zeros(len(nodes), np.int64), np.zeros(len(nodes)))
            for r in nodes:
                if r.column is None:
                    tree.value[r.node] = r.value
                else:
                    tree.column[r.node] = columns.index(r.column)
                    tree.bin[r.node] = out.cuts[tree.column[r.node]].index(r.cut)
            out.trees.append(tree)
        return out


def _number(name: str) -> Column:
    zero = F.lit(0.0)
    return F.nanvl(F.coalesce(F.col(f"`{name}`").cast("double"), zero), zero)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def find_cuts(rows: DataFrame, columns: list[str], bins: int) -> list[list[float]]:
    """Quantiles of each column, above its least value, exact at any number of rows.

    The i-th is the least value that i of ``bins`` parts of the rows reach at most.  Rows are
    counted per value; a column of very many values is counted up in ranges of them.
    """
    numbers = F.posexplode(F.array(*[_number(c) for c in columns])).alias("i", "value")
    counts = rows.select(numbers).groupBy(F.col("i").cast("string").alias("place"), "value")
    counts = stored(counts.agg(F.count(F.lit(1)).alias("n")), "values")
    total = counts.where("place = '0'").agg(F.sum("n")).first()[0] or 1
    layout = profile_sessions(counts, key="place", order=("value",))
    upto = layout.running_sum(counts, upto=F.col("n")).withColumn("before", F.col("upto") - F.col("n"))
    parts = lambda c: F.call_function("div", F.col(c) * bins, F.lit(total).cast("bigint"))
    cut = F.least(parts("upto"), F.lit(bins - 1)) > parts("before")
    found = upto.where(cut & (F.col("before") > 0)).select("place", "value").collect()  # bins - 1 a column at most
    return [sorted(r["value"] for r in found if r["place"] == str(i)) for i in range(len(columns))]


def _binned(rows: DataFrame, columns: list[str], cuts: list[list[float]], keep: list[Column]) -> DataFrame:
    numbers = rows.select(*keep, *[_number(c).alias(f"_x{i}") for i, c in enumerate(columns)])
    cut = [i for i, c in enumerate(cuts) if c]
    if cut:
        ends = [[-float("inf"), *cuts[i], float("inf")] for i in cut]
        numbers = Bucketizer(
            splitsArray=ends, inputCols=[f"_x{i}" for i in cut], outputCols=[f"_b{i}" for i in cut]
        ).transform(numbers)
    bins = [F.col(f"_b{i}") if cuts[i] else F.lit(0) for i in range(len(columns))]
    return numbers.select("key", "y", "w", F.array(*[b.cast("smallint") for b in bins]).alias("bins"))


def taken(key: Column, tree: int, share: float, seed: int) -> Column:
    """Whether a tree sees a row: a share of the hashes of seed, tree and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{tree}:"), key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < int(share * (1 << 32))


def columns_of(tree: int, columns: list[str], share: float, seed: int) -> list[int]:
    """Places of the columns a tree may use: those of the lowest hashes."""
    order = sorted(range(len(columns)), key=lambda i: hashlib.md5(f"{seed}:{tree}:{columns[i]}".encode()).hexdigest())
    return sorted(order[: max(1, int(share * len(columns)))])


def slopes(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the weighted log loss, in whole units."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint((p - y) * w * UNITS), np.rint(np.maximum(p * (1 - p), 1e-16) * w * UNITS)


def _level(rows: DataFrame, pending: list[Tree], tree: Tree, depth: int, used: list[int], bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gradient and curvature per (node of this depth, used column, bin)."""
    first, width = (1 << depth) - 1, 1 << depth
    shape = (width, len(used), bins)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, width * len(used) * bins), np.int64)
        for b in batches:
            x = _matrix(b, "bins")
            margin = b.column("margin").to_numpy().copy()
            for t in pending:
                margin += t.value[t.nodes(x)]
            at = tree.nodes(x) - first
            live = at >= 0
            g, h = (v[live] for v in slopes(margin, b.column("y").to_numpy(), b.column("w").to_numpy()))
            at, x = at[live], x[live]
            for i, c in enumerate(used):
                slot = (at * len(used) + i) * bins + x[:, c]
                for k, v in enumerate((g, h)):
                    # Doubles hold these sums exactly: a batch has few rows.
                    sums[k] += np.bincount(slot, weights=v, minlength=sums.shape[1]).astype(np.int64)
        some = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[0, some]), pa.array(sums[1, some])], ["slot", "g", "h"])

    part = rows.mapInArrow(add_up, "slot long, g long, h long")
    got = part.groupBy("slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()  # at most prod(shape) rows
    out = np.zeros((2, int(np.prod(shape))), np.int64)
    slot = got.column("slot").to_numpy()
    out[0, slot], out[1, slot] = got.column("g").to_numpy(), got.column("h").to_numpy()
    return out[0].reshape(shape), out[1].reshape(shape)


def _split(tree: Tree, node: int, g: np.ndarray, h: np.ndarray, used: list[int], s: Settings) -> bool:
    """Give a node its best cut, and its children their values; False if none is worth it.

    Of equal gains the first column's and lowest bin's counts.
    """
    whole_g, whole_h = float(g[0].sum()) / UNITS, float(h[0].sum()) / UNITS
    tree.value[node] = -whole_g / (whole_h + s.shrink) * s.rate
    low_g, low_h = np.cumsum(g, axis=1) / UNITS, np.cumsum(h, axis=1) / UNITS
    top_g, top_h = whole_g - low_g, whole_h - low_h
    gain = low_g * low_g / (low_h + s.shrink) + top_g * top_g / (top_h + s.shrink) - whole_g * whole_g / (whole_h + s.shrink)
    gain[(low_h < s.least_curvature) | (top_h < s.least_curvature)] = -np.inf
    best = int(np.argmax(gain))
    column, cut = divmod(best, g.shape[1])
    if not gain[column, cut] > LEAST_GAIN:
        return False
    tree.column[node], tree.bin[node], tree.value[node] = used[column], cut, 0.0
    for child, cg, ch in ((2 * node + 1, low_g, low_h), (2 * node + 2, top_g, top_h)):
        tree.value[child] = -cg[column, cut] / (ch[column, cut] + s.shrink) * s.rate
    return True


def fit(
    rows: DataFrame, columns: list[str], label: str = S.LABEL, key: str = "session_id",
    weight: str | None = None, settings: Settings = Settings(),
) -> Booster:
    """Boosted trees for a label of 0 and 1; rows with another label or none are not used.

    Log loss from a margin of zero, weighted rows, a share of the rows and of the columns
    per tree (both by hash, so a rerun fits the same trees), leaves -G / (H + shrink).
    Without ``weight`` ones weigh zeros over ones.  Null and NaN values count as zero, a
    null key as the empty text; rows of one key go to a tree together.  No rows give
    trees of one leaf with the value 0.
    """
    s = settings
    rows = rows.where(F.col(f"`{label}`").isin(0, 1))
    if weight is None:
        neg, pos = rows.agg(F.count_if(F.col(f"`{label}`") == 0), F.count_if(F.col(f"`{label}`") == 1)).first()
        w = F.when(F.col(f"`{label}`") == 1, neg / max(pos, 1)).otherwise(1.0)
    else:
        w = F.col(f"`{weight}`").cast("double")
    out = Booster(list(columns), find_cuts(rows, columns, s.bins))
    keep = [
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
        F.col(f"`{label}`").cast("double").alias("y"), w.alias("w"),
    ]
    ready = stored(_binned(rows, columns, out.cuts, keep).withColumn("margin", F.lit(0.0)), "binned")
    pending: list[Tree] = []
    for t in range(s.trees):
        if len(pending) == REFRESH:
            ready, pending = stored(_with_margin(ready, pending), "margins"), []
        used = columns_of(t, out.columns, s.column_share, s.seed)
        tree = Tree.of_depth(s.depth)
        some = ready.where(taken(F.col("key"), t, s.row_share, s.seed)).drop("key")
        open_nodes = {0}
        for depth in range(s.depth):
            g, h = _level(some, pending, tree, depth, used, s.bins)
            first, found = (1 << depth) - 1, set()
            for node in sorted(open_nodes):
                if _split(tree, node, g[node - first], h[node - first], used, s):
                    found |= {2 * node + 1, 2 * node + 2}
            open_nodes = found
            if not found:
                break
        out.trees.append(tree)
        pending.append(tree)
    return out


def _with_margin(rows: DataFrame, trees: list[Tree]) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, margin = _matrix(b, "bins"), b.column("margin").to_numpy().copy()
            for t in trees:
                margin += t.value[t.nodes(x)]
            cols = [pa.array(margin) if n == "margin" else b.column(n) for n in b.schema.names]
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return rows.mapInArrow(add, rows.schema)
