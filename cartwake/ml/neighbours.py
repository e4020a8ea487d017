"""Exact nearest neighbours by blocks around pivots.

Every row belongs to the cell of its nearest pivot, and a cell's rows to blocks of bounded
size.  The neighbours in a row's own block bound how far its nearest ones can be, and by the
triangle inequality it then visits only blocks of cells that reach as near.  No row is
compared with a block that cannot matter, none that can is left out.  Equal vectors are one
member with its first keys, so a vector that very many rows share is a single member.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwake.sources.files import stored

#: Most pivots; they and their radii are all that passes through the driver.
MOST_PIVOTS = 256
#: Members of a block, and visitors that a task compares with one at a time.
BLOCK_ROWS = 4096
#: Distances that agree to so many places are equal; then the smaller key is nearer.
PLACES = 9

_MEMBER = "id long, v array<double>, keys array<string>, cell int, far double, part int"
_NEAR = "id long, distance double, key string"


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of ``a`` by rows of ``b``, a few rows at a time."""
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = np.sqrt(((a[i : i + step, None, :] - b[None]) ** 2).sum(axis=2))
    return out.round(PLACES)


def _nearest(d: np.ndarray, keys: list[list[str]], own: list[str] | None, k: int) -> list[tuple[float, str]]:
    """The ``k`` nearest keys of one row, given its distances to members.

    ``own`` are the keys of the row's vector, which come in by themselves.
    """
    few = np.argsort(d, kind="stable")
    found: list[tuple[float, str]] = []
    for j in few.tolist():
        if len(found) >= k and d[j] > found[k - 1][0]:
            break
        if keys[j] is not own:
            found += [(float(d[j]), key) for key in keys[j][:k]]
            found.sort()
            del found[k:]
    return found


def nearest(rows: DataFrame, k: int, key: str = "key", vector: str = "v") -> DataFrame:
    """``key``, ``rank`` (from 1), ``neighbour`` and ``distance``: each row's ``k`` nearest others.

    Euclidean distance, to nine places; equal distances by the smaller key.  ``key`` is a
    string that names one row, ``vector`` an array of doubles of one length without nulls.
    A table of fewer than ``k`` others gives what there is, an empty one nothing.
    """
    rows = rows.select(F.col(key).alias("key"), F.col(vector).alias("v"))
    first = Window.partitionBy("v").orderBy("key")
    members = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    members = members.groupBy("v").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    members = stored(members.withColumn("id", F.monotonically_increasing_id()), "members")
    n = members.count()
    if n == 0:
        return rows.sparkSession.createDataFrame([], "key string, rank int, neighbour string, distance double")
    most = min(MOST_PIVOTS, int(np.ceil(np.sqrt(n))))
    pivots = np.array([r.v for r in members.select("v").orderBy(F.xxhash64("v"), "id").limit(most).collect()])
    width = pivots.shape[1]

    def place(batches):
        for batch in batches:
            d = _distances(_matrix(batch.column("v"), width), pivots)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "v", "keys")), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                ["id", "v", "keys", "cell", "far"],
            )

    placed = stored(members.select("id", "v", "keys").mapInArrow(place, _MEMBER.removesuffix(", part int")), "cells")
    cells = {r.cell: (r.n, r.radius) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()}
    parts = {c: -(-size // BLOCK_ROWS) for c, (size, _) in cells.items()}
    spread = F.create_map(*[F.lit(x) for c, p in sorted(parts.items()) for x in (c, p)])
    placed = placed.withColumn("part", F.pmod(F.xxhash64("id"), spread[F.col("cell")]).cast("int"))

    near_cells = np.array(sorted(cells))
    radius = np.array([cells[c][1] for c in near_cells.tolist()])
    near_pivots = pivots[near_cells]

    def at_home(block: pa.Table) -> pa.Table:
        """Neighbours in the row's own block, and the other blocks that it has to visit."""
        ids, v = block.column("id").to_numpy(), _matrix(block.column("v"), width)
        keys, cell = block.column("keys").to_pylist(), block.column("cell")[0].as_py()
        part, out = block.column("part")[0].as_py(), []
        to_pivots = _distances(v, near_pivots)
        for i in range(0, len(ids), 256):
            d = _distances(v[i : i + 256], v)
            for j, row in enumerate(d, start=i):
                found = _nearest(row, keys, keys[j], k)
                copies = keys[j][: k + 1]
                # Members within the bound, copies of the row itself counted first.
                reach = 0.0 if len(copies) > k else found[k - len(copies)][0] if len(found) > k - len(copies) else np.inf
                go = [] if len(copies) > k else near_cells[to_pivots[j] - radius <= reach + 1e-6].tolist()
                visits = [{"cell": c, "part": p} for c in go for p in range(parts[c]) if (c, p) != (cell, part)]
                out.append((ids[j], [{"distance": a, "key": b} for a, b in found], visits))
        return pa.table(
            [pa.array(ids), block.column("v"), pa.array([o[1] for o in out], _found), pa.array([o[2] for o in out], _visits)],
            ["id", "v", "found", "visits"],
        )

    home = stored(
        placed.groupBy("cell", "part").applyInArrow(
            at_home, "id long, v array<double>, found array<struct<distance:double,key:string>>, visits array<struct<cell:int,part:int>>"
        ),
        "home",
    )
    visits = home.select("id", "v", F.explode("visits").alias("to")).select("id", "v", "to.*")
    # A block that very many rows visit is given to several tasks.
    shares = visits.groupBy("cell", "part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("shares"))
    visitors = visits.join(shares, ["cell", "part"]).withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int"))
    hosts = placed.join(shares, ["cell", "part"]).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))

    def visit(guests: pa.Table, block: pa.Table) -> pa.Table:
        ids, v = guests.column("id").to_numpy(), _matrix(guests.column("v"), width)
        keys, members = block.column("keys").to_pylist(), _matrix(block.column("v"), width)
        out: list[tuple] = []
        for i in range(0, len(ids), 256):
            for j, row in enumerate(_distances(v[i : i + 256], members), start=i):
                out += [(ids[j], *f) for f in _nearest(row, keys, None, k)]
        columns = zip(*out) if out else ([], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.float64(), pa.string()))], ["id", "distance", "key"])

    names = ["cell", "part", "share"]
    met = (
        visitors.select(*[F.col(c).alias(c) for c in [*names, "id", "v"]]).groupBy(*names)
        .cogroup(hosts.select(*[F.col(c).alias(c) for c in [*names, "v", "keys"]]).groupBy(*names))
        .applyInArrow(visit, _NEAR)
    )
    others = home.select("id", F.explode("found").alias("f")).select("id", "f.*").unionByName(met)
    others = others.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("distance", "key"))).where(F.col("n") <= k)
    others = others.groupBy("id").agg(F.collect_list(F.struct("distance", F.col("key").alias("neighbour"))).alias("others"))
    # Copies of a row's vector are its nearest, at distance 0, but not the row itself.
    lists = members.join(others, "id", "left").select(
        "v", F.concat(F.transform("keys", lambda c: F.struct(F.lit(0.0).alias("distance"), c.alias("neighbour"))),
                      F.coalesce("others", F.array().cast("array<struct<distance:double,neighbour:string>>"))).alias("all"),
    )
    mine = rows.join(lists, "v").select("key", F.filter("all", lambda x: x["neighbour"] != F.col("key")).alias("all"))
    return mine.select("key", F.posexplode(F.slice(F.array_sort("all"), 1, k)).alias("pos", "x")).select(
        "key", (F.col("pos") + 1).alias("rank"), "x.neighbour", "x.distance"
    )


_found = pa.list_(pa.struct([("distance", pa.float64()), ("key", pa.string())]))
_visits = pa.list_(pa.struct([("cell", pa.int32()), ("part", pa.int32())]))
