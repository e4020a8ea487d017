"""Connected components of a link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwake.sources.files import stored


def _least(links: DataFrame) -> DataFrame:
    """The least neighbour of each node, or itself if that is less."""
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each greater neighbour of a node points to the least one."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, point to the least one."""
    least = _least(links)
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def stars(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``u`` (each node that is not least in its component) and ``v`` (the least one).

    ``links`` holds pairs of long node ids, in any direction; repeats and pairs of a node
    with itself are ignored.  Nodes stay in Spark: a step is a partial minimum and an
    equi-join, each written to the shared folder, and the number of steps grows with the
    logarithm of the longest chain.  A node of very many links is one row of minima, and
    adaptive execution splits its side of the join.
    """
    kind = "u long, v long"
    out = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    out = stored(out.where("u <> v").distinct(), "links")
    state = _state(out)
    while True:
        if state[0] == 0:
            return out
        large = _large_star(out).where("u <> v").distinct()
        out = stored(_small_star(large).where("u <> v").distinct().to(_schema(kind)), "links")
        now = _state(out)
        if now == state:
            return out
        state = now


def _schema(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(text)
