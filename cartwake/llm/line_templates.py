"""Recurring lines by a log-template tree.

The tree sorts lines by token count and leading tokens; tokens with digits are variable from
the start.  In a leaf, different lines join the template with which they share most tokens by
position, if those are at least ``LEAST_SHARED`` of all; positions that differ become variable.
Lines of templates that stand in ``MIN_DOCS`` documents or more are dropped everywhere.

Only leaves that enough documents reach are looked into, and there each different line
counts once, with its documents counted before.  A leaf of more than ``LEAF_LINES`` different
lines is divided into parts that do not change what the tree finds: a line only ever joins a
template whose first line shares enough tokens with it, so lines that no chain of such pairs
connects can be worked on apart, each part in the order of the leaf.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwake.llm.common import free, others, slices, text_of
from cartwake.llm.components import stars
from cartwake.sources.files import stored

LEADING = 3
LEAST_TOKENS = 3
LEAST_SHARED = 0.6
MIN_DOCS = 10
LEAF_LINES = 1000
LONG_TOKENS = 50
VARIABLE = "<*>"


def tokens_of(line: str) -> list[str]:
    """Tokens between white space; one with a digit is variable."""
    return [VARIABLE if any(map(str.isdigit, t)) else t for t in line.split()]


def _key(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _leaf(tokens: list[str], leading: int) -> int:
    return _key(f"{len(tokens)} {' '.join(tokens[:leading])}")


def _needed(least: float, size: int) -> int:
    """Tokens that a line of ``size`` tokens must share with a template."""
    return max(1, ceil(least * size - 1e-9))


class Leaf:
    """Templates of one leaf; lines are added in a fixed order."""

    def __init__(self, least: float = LEAST_SHARED):
        self.least, self.templates = least, []
        self.index: dict[tuple[int, str], set[int]] = {}

    def add(self, tokens: list[str]) -> int:
        """The place of the template that a line joins."""
        need = _needed(self.least, len(tokens))
        places = [x for x in enumerate(tokens) if x[1] != VARIABLE]
        k, n = 0, 0
        if len(places) >= need:
            # Whoever shares ``need`` places misses too few to miss all of the rarest ones.
            lists = sorted((self.index.get(x, ()) for x in places), key=len)
            for c in set().union(*lists[: len(places) - need + 1]):
                own = self.templates[c]
                shared = sum(own[i] == t for i, t in places)
                if shared > n or shared == n and c < k:
                    k, n = c, shared
        if n < need:
            k = len(self.templates)
            self.templates.append(list(tokens))
            for x in places:
                self.index.setdefault(x, set()).add(k)
            return k
        own = self.templates[k]
        for i, t in enumerate(tokens):
            if own[i] not in (t, VARIABLE):
                self.index[(i, own[i])].discard(k)
                own[i] = VARIABLE
        return k


def _lines(docs: DataFrame, leading: int, least_tokens: int) -> DataFrame:
    """``row``, ``place``, ``leaf``, ``mask`` and ``line`` (with variable tokens) of each line."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "place", "leaf", "mask", "line"]
        for batch in slices(batches, "text", 1 << 20):
            cols: list[list] = [[] for _ in names]
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                for place, line in enumerate(text.split("\n")):
                    tokens = tokens_of(line)
                    if len(tokens) < least_tokens:
                        continue
                    masked = " ".join(tokens)
                    for col, value in zip(cols, (row, place, _leaf(tokens, leading), _key(masked), masked)):
                        col.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return docs.mapInArrow(work, "row long, place int, leaf long, mask long, line string")


def _templates(different: DataFrame, least: float) -> DataFrame:
    """``mask`` and ``template`` of the different lines of busy leaves."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leaf = None, None
        for batch in batches:
            out = []
            for key, line in zip(batch.column("leaf").to_pylist(), batch.column("line").to_pylist()):
                if leaf is None or key != at:
                    at, leaf = key, Leaf(least)
                out.append(leaf.add(line.split(" ")))
            yield pa.RecordBatch.from_arrays([batch.column("leaf"), batch.column("mask"), pa.array(out, pa.int32())], ["leaf", "mask", "template"])

    ordered = different.repartition("leaf").sortWithinPartitions("leaf", F.desc("n"), "line")
    return ordered.mapInArrow(work, "leaf long, mask long, template int")


def _keys(lines: DataFrame, least: float, leading: int) -> DataFrame:
    """``key`` and ``mask``: lines of a leaf that share enough tokens share a key.

    A key is a token at its place.  The leading tokens are equal in a leaf, so of the other
    places only so many can differ; of the rarest ones, one more than that is listed.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["mask", "most", "key"]
        for batch in slices(batches, "line", 1 << 18):
            cols: list[list] = [[] for _ in names]
            for leaf, mask, line in zip(*(batch.column(c).to_pylist() for c in ("leaf", "mask", "line"))):
                tokens = line.split(" ")
                places = [x for x in enumerate(tokens) if x[1] != VARIABLE]
                most = len(places) - _needed(least, len(tokens)) + 1
                for i, t in places if most > 0 else ():
                    if i >= leading:
                        for col, value in zip(cols, (mask, most, _key(f"{leaf} {i} {t}"))):
                            col.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    every = stored(lines.mapInArrow(work, "mask long, most int, key long"), "line-places")
    often = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # Places that no other line has are the rarest of all, and link nothing.
    rare = every.join(often, "key", "left").groupBy("mask").agg(
        F.min("most").alias("most"),
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "key"))).alias("keys"),
    )
    listed = rare.select("mask", F.explode(F.expr("slice(keys, 1, most)")).alias("k"))
    return listed.where("k.n > 1").select("k.key", "mask")


def _pair_links(listed: DataFrame, least: float) -> DataFrame:
    """``u``, ``v``: lines under one key that share enough tokens."""

    def close(masks: list[int], lines: list[str]) -> Iterator[tuple[int, int]]:
        codes: dict[str, int] = {VARIABLE: 0}
        rows = np.array([[codes.setdefault(t, len(codes)) for t in x.split(" ")] for x in lines], np.int32)
        need = _needed(least, rows.shape[1])
        label = np.arange(len(rows))
        for i in range(1, len(rows)):
            near = np.flatnonzero(((rows[:i] == rows[i]) & (rows[i] > 0)).sum(axis=1) >= need)
            if len(near):
                joined = np.unique(label[near])
                for k in joined:
                    yield masks[i], masks[k]
                label[: i + 1][np.isin(label[: i + 1], joined)] = joined[0]
                label[i] = joined[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, masks, lines = None, [], []

        def found() -> pa.RecordBatch:
            pairs = list(close(masks, lines)) if len(masks) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["u", "v"])

        for batch in batches:
            for key, mask, line in zip(*(batch.column(c).to_pylist() for c in ("key", "mask", "line"))):
                if key != at:
                    yield found()
                    at, masks, lines = key, [], []
                masks.append(mask)
                lines.append(line)
        yield found()

    return listed.repartition("key").sortWithinPartitions("key").mapInArrow(work, "u long, v long").distinct()


def _divide_full(different: DataFrame, leading: int, least: float, most: int) -> DataFrame:
    """Full leaves in parts between which no line can join a template of another part.

    Lines under a key are compared in pairs; those under a key of more than ``most`` lines
    stay in one part without a look, which divides less but changes no template.
    """
    full = different.groupBy("leaf").agg(F.count("*").alias("lines")).where(F.col("lines") > most).select("leaf")
    full = stored(full, "full-leaves")
    if not full.take(1):
        return different
    lines = different.join(full, "leaf", "left_semi")
    listed = stored(_keys(lines, least, leading), "line-keys")
    sizes = listed.groupBy("key").agg(F.count("*").alias("n"), F.min("mask").alias("v"))
    small = listed.join(sizes.where(F.col("n") <= most).select("key"), "key", "left_semi")
    small = small.join(lines.select("mask", "line"), "mask")
    large = listed.join(sizes.where(F.col("n") > most).select("key", "v"), "key")
    found = _pair_links(small, least).unionByName(large.select(F.col("mask").alias("u"), "v"))
    # Where the leading tokens alone are enough, all lines of the leaf have one template.
    tokens = F.split("line", " ")
    led = F.size(F.filter(F.slice(tokens, 1, leading), lambda t: t != VARIABLE))
    apart = led < F.greatest(F.lit(1), F.ceil(F.lit(least) * F.size(tokens) - F.lit(1e-9)))
    parts = stars(found).select(F.col("u").alias("mask"), F.col("v").alias("part"))
    joined = different.join(full.withColumn("full", F.lit(True)), "leaf", "left").join(parts, "mask", "left")
    leaf = F.when(F.col("full") & apart, F.xxhash64("leaf", F.coalesce("part", "mask"))).otherwise(F.col("leaf"))
    return joined.withColumn("leaf", leaf).select(*different.columns)


def recurring(
    lines: DataFrame, leading: int = LEADING, least: float = LEAST_SHARED, min_docs: int = MIN_DOCS, leaf_lines: int = LEAF_LINES,
    long_docs: int | None = None,
) -> DataFrame:
    """``mask`` of every line whose template stands in at least ``min_docs`` documents.

    With ``long_docs``, that many are enough for lines of ``LONG_TOKENS`` tokens or more.
    """
    # Lines of a leaf and of a template have one number of tokens.
    many, size = F.lit(min_docs), F.lit(0)
    if long_docs is not None:
        many = F.when(F.col("size") >= LONG_TOKENS, long_docs).otherwise(min_docs)
        size = F.size(F.split("line", " "))
    reach = lines.select("leaf", "row", size.alias("size")).distinct().groupBy("leaf").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    busy = lines.join(reach.where(F.col("n") >= many).select("leaf"), "leaf", "left_semi")
    # Documents are counted per different line first, so a common line is one row from here.
    pairs = stored(busy.groupBy("leaf", "mask", "row").agg(F.min("line").alias("line")), "line-documents")
    different = pairs.groupBy("leaf", "mask").agg(F.min("line").alias("line"), F.count("*").alias("n"))
    known = stored(_templates(_divide_full(stored(different, "lines"), leading, least, leaf_lines), least), "line-templates")
    known = known.select("mask", F.xxhash64("leaf", "template").alias("template"))
    docs = pairs.select("mask", "row", size.alias("size")).join(known, "mask").select("template", "row", "size").distinct()
    often = docs.groupBy("template").agg(F.count("*").alias("n"), F.max("size").alias("size")).where(F.col("n") >= many)
    return known.join(often.select("template"), "template", "left_semi").select("mask").distinct()


def _row(docs: DataFrame) -> Column:
    kinds = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(f"`{c}`") for c in kinds])


def drop_recurring(
    docs: DataFrame, text: str = "text", leading: int = LEADING, least_tokens: int = LEAST_TOKENS,
    least: float = LEAST_SHARED, min_docs: int = MIN_DOCS, leaf_lines: int = LEAF_LINES, long_docs: int | None = None,
) -> DataFrame:
    """``docs`` without recurring lines in ``text``; adds ``n_lines`` and ``n_dropped``.

    Lines of fewer than ``least_tokens`` tokens always stay.  Rows equal in every value are
    one document for counting, and all of them stay as rows.  Null texts stay null and have
    no lines; an empty text is one line.  Columns of the added names are replaced.

    With ``long_docs``, lines of ``LONG_TOKENS`` tokens or more recur in that many documents.
    Copies of a document count, so with few documents take one of each group first.
    """
    own = ["n_lines", "n_dropped"]
    docs = docs.select(*[F.col(f"`{c}`") for c in others(docs.columns, own)])
    row, places_of = free(docs.columns, "_row"), free(docs.columns, "_places")
    keyed = docs.withColumn(row, _row(docs))
    lines = stored(_lines(keyed.select(F.col(row).alias("row"), text_of(f"`{text}`").alias("text")), leading, least_tokens), "document-lines")
    gone = recurring(lines, leading, least, min_docs, leaf_lines, long_docs)
    places = lines.select("row", "place", "mask").join(gone, "mask", "left_semi").groupBy("row").agg(
        F.collect_set("place").alias(places_of)
    )
    parts = F.split(F.col(f"`{text}`"), "\n", -1)
    kept = F.array_join(F.filter(parts, lambda _, i: ~F.array_contains(F.col(places_of), i)), "\n")
    joined = keyed.join(places.withColumnRenamed("row", row), row, "left")
    return joined.withColumns({
        "n_lines": F.coalesce(F.size(parts), F.lit(0)).cast("long"),
        "n_dropped": F.coalesce(F.size(places_of), F.lit(0)).cast("long"),
        text: F.when(F.col(places_of).isNull(), F.col(f"`{text}`")).otherwise(kept),
    }).drop(row, places_of)
