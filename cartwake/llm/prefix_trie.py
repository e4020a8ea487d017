"""Conversations as a trie of their turns, totals of subtrees rolled up by depth bands.

A node is a distinct sequence of first turns.  It is known by its depth and two 64-bit
lanes, running exclusive ors of hashes of each turn and its place, so no task holds a
conversation.  Depths are cut into bands of fixed height: a node adds its value to its
ancestors in the band only (at most ``band`` rows), and the finished totals of band roots
are added to the band above.  The rounds are the depth over ``band``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwake.llm.common import WORD, text_of
from cartwake.sources.files import shared_folder, stored

#: Depths of a band: the most ancestors that a node's row becomes in a round.
BAND = 8
#: Ids of a node joined into one piece of text, before its digest reads them in order.
CHUNK = 4096

KEY = ["depth", "k1", "k2"]


def turns_of(table: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 0), lanes ``a`` and ``b`` of role and text, and ``words``.

    Turns stand by ``turn``, null first; equal turns by role, then text.  Null roles and
    texts are empty.  Rows without conv_id belong to no conversation and are left out.
    Repeated rows are turns of their own.  Other columns are not read.
    """
    rows = table.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        text_of("role").alias("role"), text_of("text").alias("text"),
    ).where("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select(
        "conv_id", (F.row_number().over(order) - 1).alias("place"),
        F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "text", "role").alias("b"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )


def with_shared_heads(turns: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first turns taken from the first of its family.

    The first h = crc32(decimal conv_id) % ``most`` turns are those of the conversation
    conv_id - conv_id % ``family`` (all it has if fewer, none if it is absent); its own
    turns after the first h follow.  Every conversation has a row of ``part`` 0 before its
    turns, so one that loses all turns is not lost.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = turns.select("conv_id").where("place = 0").select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("head"), h.alias("h")
    )
    heads = turns.where((F.col("conv_id") % family == 0) & (F.col("place") < most - 1)).withColumnRenamed("conv_id", "head")
    taken = convs.join(heads, "head").where("place < h")
    value = ["place", "a", "b", "words"]
    return (
        taken.select("conv_id", F.lit(1).alias("part"), *value)
        .unionByName(turns.where(F.col("place") >= h).select("conv_id", F.lit(2).alias("part"), *value))
        .unionByName(convs.select("conv_id", F.lit(0).alias("part")), allowMissingColumns=True)
    )


def prefixes(parts: DataFrame, band: int = BAND) -> DataFrame:
    """One row per conversation and prefix, the empty one included.

    Columns: conv_id, depth, k1, k2, words (of the last turn), ``last`` (the conversation
    ends there) and the lanes of the ``band`` prefixes before it, ``u1_1 u2_1 ...``.
    """
    order = Window.partitionBy("conv_id").orderBy("part", "place")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = parts.withColumn("depth", (F.row_number().over(order) - 1).cast("long"))
    lane = lambda *c: F.when(F.col("depth") > 0, F.xxhash64(*c)).otherwise(0)
    rows = rows.withColumns(
        {
            "k1": F.bit_xor(lane("depth", "a", "b")).over(so_far),
            "k2": F.bit_xor(lane(F.lit(2), "b", "depth", "a")).over(so_far),
            "words": F.coalesce("words", F.lit(0)),
        }
    )
    ups = {f"u{k}_{i}": F.lag(f"k{k}", i).over(order) for i in range(1, band + 1) for k in (1, 2)}
    return rows.withColumns(ups | {"last": F.lead("depth").over(order).isNull()}).select(
        "conv_id", *KEY, "words", "last", *ups
    )


def _ancestors(band: int) -> Column:
    """Keys of a node's ancestors down to the first depth of its parent's band."""
    found = [
        F.struct((F.col("depth") - i).alias("depth"), F.col(f"u1_{i}").alias("k1"), F.col(f"u2_{i}").alias("k2"))
        for i in range(1, band + 1)
    ]
    return F.slice(F.array(*found), 1, F.when(F.col("depth") > 0, ((F.col("depth") - 1) % band + 1).cast("int")).otherwise(0))


def roll_up(nodes: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """``KEY`` and the sums of ``values`` over each node's subtree, itself included.

    ``nodes``: KEY, the lanes of the prefixes before (``prefixes``) and ``values``.
    Bands are worked on from the deepest; a node's rows in a round are itself and its
    ancestors in the band, and a finished band root's total goes to the band above.
    """
    # A round reads the folder of its band alone.
    path = shared_folder(nodes.sparkSession, "bands")
    ups = [f"u{k}_{i}" for i in range(1, band + 1) for k in (1, 2)]
    nodes = nodes.select(*KEY, *ups, *values).withColumn("band", F.floor(F.col("depth") / band))
    nodes.write.partitionBy("band").parquet(path)
    nodes = nodes.sparkSession.read.schema(nodes.schema).parquet(path)
    deepest = nodes.agg(F.max("band")).first()[0]
    if deepest is None:
        return nodes.select(*KEY, *values)
    itself = F.array(F.struct(*KEY))
    done, roots = [], None
    for b in range(deepest, -1, -1):
        rows = nodes.where(F.col("band") == b)
        # A band root's ancestors lie in the band above; its total goes there when it is finished.
        inside = F.when(F.col("depth") % band == 0, itself).otherwise(F.concat(itself, _ancestors(band)))
        given = rows.select(F.explode(inside).alias("to"), *values)
        if roots is not None:
            given = given.unionByName(roots.select(F.explode(_ancestors(band)).alias("to"), *values))
        total = given.groupBy("to").agg(*[F.sum(v).alias(v) for v in values]).select("to.*", *values)
        done.append(stored(total, "band"))
        if b:
            at = F.col("depth") == b * band
            roots = done[-1].where(at).join(rows.where(at).select(*KEY, *ups), KEY)
    return reduce(DataFrame.unionByName, done)


def end_digests(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``KEY`` and ``ends_sha256`` of the conv_ids that end at each node, ascending.

    Ids are sorted over all tasks and joined to pieces of ``chunk`` there; a node's pieces
    then pass in order through one running digest, so no task holds a node's ids.
    """
    kind = "depth long, k1 long, k2 long, first long, ids string"
    names = [*KEY, "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        out: list[tuple] = []
        for batch in batches:
            for d, k1, k2, c in zip(*(batch.column(n).to_pylist() for n in names)):
                if held and ((d, k1, k2) != key or len(held) == chunk):
                    out.append((*key, held[0], ",".join(map(str, held))))
                    held = []
                key = (d, k1, k2)
                held.append(c)
            if len(out) >= 1000:
                yield _batch(out, [*KEY, "first", "ids"])
                out = []
        if held:
            out.append((*key, held[0], ",".join(map(str, held))))
        if out:
            yield _batch(out, [*KEY, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        out: list[tuple] = []
        for batch in batches:
            for d, k1, k2, ids in zip(*(batch.column(n).to_pylist() for n in [*KEY, "ids"])):
                if (d, k1, k2) == key:
                    state.update(b",")
                else:
                    if state:
                        out.append((*key, state.hexdigest()))
                    key, state = (d, k1, k2), hashlib.sha256()
                state.update(ids.encode())
            if len(out) >= 1000:
                yield _batch(out, [*KEY, "ends_sha256"])
                out = []
        if state:
            yield _batch([*out, (*key, state.hexdigest())], [*KEY, "ends_sha256"])

    pieces = ends.select(*names).repartitionByRange(*names).sortWithinPartitions(*names).mapInArrow(join, kind)
    pieces = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return pieces.mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if n in ("ids", "ends_sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def trie(prefix_rows: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie of ``prefixes``.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves (childless nodes of the subtree), saved_tokens (of the subtree:
    words of each node's last turn, for all members but one), ends_sha256, and the key
    ``k1``, ``k2``.  No conversation gives no node, not even a root.
    """
    members = stored(prefix_rows, "prefixes")
    ups = [f"u{k}_{i}" for i in range(1, band + 1) for k in (1, 2)]
    nodes = members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        *[F.min(c).alias(c) for c in ["words", *ups]],
    )
    nodes = stored(nodes, "nodes")
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("u1_1").alias("k1"), F.col("u2_1").alias("k2"))
    known = nodes.join(kids.agg(F.count("*").alias("n_children")), KEY, "left").withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0)),
            "n_leaves": F.col("n_children").isNull().cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    known = stored(known, "trie")
    totals = roll_up(known, ["n_leaves", "saved_tokens"], band)
    ends = end_digests(members.where("last"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("u1_1"), F.col("k2").alias("u2_1"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    nothing = hashlib.sha256().hexdigest()
    return (
        known.drop("n_leaves", "saved_tokens")
        .join(totals, KEY)
        .join(ends, KEY, "left")
        .join(parents, ["depth", "u1_1", "u2_1"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), "k1", "k2",
        )
    )


def shared_head_trie(table: DataFrame, family: int = 20, most: int = 4, band: int = BAND) -> DataFrame:
    """The trie of conversations that take their first turns from their family's first."""
    turns = stored(turns_of(table), "turns")
    return trie(prefixes(with_shared_heads(turns, family, most), band), band)
