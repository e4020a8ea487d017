"""Near-duplicate documents by SimHash and a byte-position inverted index.

Two fingerprints that differ in at most four of 64 bits agree in at least four of their
eight bytes.  The index therefore lists fingerprints under the values of every choice of
four byte positions: a pair with m equal bytes meets in C(m, 4) lists, so a pair whose
tally of shared positional bytes falls short of four is never made, and each pair that
reaches the minimum is verified on all bits.  (Lists of single byte positions hold a
256th of all fingerprints each, which makes their pairs grow with the square of the
input; lists of four positions need no such tallies.)

Links inside a list are kept as stars of its own components, at most one per member.
A list of more than ``LIST_MOST`` different fingerprints is worked through by midpoints
instead: each member is listed under every value within two bits of its other four
bytes, and all members under one value are within four bits of each other.  That is
exact and linear in the members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwake.llm.common import free, others, per_text
from cartwake.llm.components import stars
from cartwake.sources.files import stored

SHINGLE_WORDS = 4
SEED = 42
BITS = 4
LIST_MOST = 2048

#: Masks of all choices of four of eight bytes.
MASKS = [sum(0xFF << (8 * p) for p in c) for c in combinations(range(8), 8 - BITS)]


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """A bit is 1 if more than half of the shingle hashes have it; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[width - 1 :]) if len(words) >= width else [(0, len(joined))]
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype="<u8").view("<i8"))


def with_fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns and ``fp``, a signed long.  Null texts count as empty."""
    keep = others(docs.columns if keep is None else keep, ["fp"])
    return per_text(docs, text, keep, {"fp": "long"}, lambda: lambda texts: [_signed([fingerprint(t) for t in texts])])


def _list_links(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stars of the components that verified pairs of one list make."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= BITS
    label = np.arange(len(fps))
    while True:
        least = np.where(near, label[None, :], len(fps)).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    far = np.flatnonzero(label != np.arange(len(fps)))
    if len(far):
        yield fps[far], fps[label[far]]


def _walk(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Lists in sorted order: (0, links), or (1, choice and member) of a long list."""
    held_key, held, long = None, [], False

    def close():
        if held_key is not None and not long:
            fps = np.concatenate(held)
            if len(fps) > 1:
                for u, v in _list_links(fps):
                    yield 0, u, v

    for batch in batches:
        choice = batch.column("choice").to_numpy()
        fp = batch.column("fp").to_numpy().view("<u8")
        key = batch.column("bytes").to_numpy().view("<u8")
        if not len(fp):
            continue
        cut = np.flatnonzero((np.diff(key) != 0) | (np.diff(choice) != 0)) + 1
        first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(fp)]))
        size = last - first
        # Whole lists of two, the most common ones, at once.
        inner = np.zeros(len(size), dtype=bool)
        inner[1:-1] = True
        two = first[inner & (size == 2)]
        good = np.bitwise_count(fp[two] ^ fp[two + 1]) <= BITS
        if good.any():
            yield 0, fp[two + 1][good], fp[two][good]
        for g in np.flatnonzero(~inner | (size > 2)).tolist():
            a, b = first[g], last[g]
            now = (choice[a], key[a])
            if now != held_key:
                yield from close()
                held_key, held, long = now, [], False
            held.append(fp[a:b])
            if long or sum(map(len, held)) > most:
                long = True
                for part in held:
                    yield 1, np.full(len(part), now[0], dtype="<u8"), part
                held = []
    yield from close()


def _midpoints(members: DataFrame) -> DataFrame:
    """Links of long lists: members that share a value within two bits of each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            choice = batch.column("u").to_numpy()
            fp = batch.column("v").to_numpy().view("<u8")
            for c in np.unique(choice).tolist():
                own = fp[choice == c]
                free = [i for i in range(64) if not MASKS[c] >> i & 1]
                flips = [0, *(1 << i for i in free), *((1 << i) | (1 << j) for i, j in combinations(free, 2))]
                for flip in flips:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((own ^ np.uint64(flip)).view("<i8")), pa.array(own.view("<i8"))], ["mid", "fp"]
                    )

    listed = members.mapInArrow(work, "mid long, fp long")
    least = listed.groupBy("mid").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1")
    return listed.join(least, "mid").where(F.col("fp") != F.col("v")).select(F.col("fp").alias("u"), "v").distinct()


def links(fps: DataFrame, most: int = LIST_MOST) -> DataFrame:
    """``u``, ``v``: links that connect all pairs of different ``fp`` within four bits.

    The pairs that are close but left out are joined by a path of others.
    """
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in MASKS])
    listed = fps.select("fp", F.posexplode(masks).alias("choice", "mask")).select(
        "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("bytes"), "fp"
    )
    spread = listed.repartition("choice", "bytes").sortWithinPartitions("choice", "bytes")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, u, v in _walk(batches, most):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(u), kind, np.int32)), pa.array(u.view("<i8")), pa.array(v.view("<i8"))],
                ["kind", "u", "v"],
            )

    found = stored(spread.mapInArrow(work, "kind int, u long, v long").distinct(), "near")
    short = found.where("kind = 0").select("u", "v")
    long = found.where("kind = 1")
    return short.unionByName(_midpoints(long)) if long.take(1) else short


def _grouped(marked: DataFrame) -> DataFrame:
    """``marked`` rows (doc_id, fp, ...) with root and component_id."""
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    roots = stars(links(classes.select("fp")))
    rooted = classes.join(roots.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return marked.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` and ``component_id``.

    ``component_id`` is the least doc_id of all documents that links reach; equal
    fingerprints are linked, so are all documents without words.  Null texts count as
    empty.  Documents without an id take part and have the component of the others, null
    if none of those has an id.  Repeated rows stay; other columns are not read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = stored(with_fingerprints(rows, keep=["doc_id"]), "fingerprints")
    return _grouped(marked).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but one document of each group.

    The one with the least id stays; of several rows with that id, the one whose values
    have the least hash.  A group without ids keeps the row with the least hash.
    """
    kinds = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    row = F.xxhash64(*[F.col(f"`{c}`") for c in kinds])
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), row.alias("row"))
    grouped = _grouped(stored(with_fingerprints(rows, keep=["doc_id", "row"]), "fingerprints"))
    chosen = grouped.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    own = free(docs.columns, "_row")
    chosen = chosen.groupBy("root").agg(F.min("row").alias(own)).select(own).distinct()
    # Rows of one hash are repeats of one row.
    kept = docs.withColumn(own, row).join(chosen, own, "left_semi")
    return kept.dropDuplicates([own]).drop(own)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
