"""Ranked lexical search by pipelined term partitioning.

``build_index`` writes posting lists in blocks of documents, each by one task with no
shuffle.  ``search`` deals the terms of the query items to a few owners by how common they
are.  Items travel in bundles: a bundle carries, for one block of documents, sparse
accumulators (document, score so far) through the owners' stages, rarest terms first, and
each stage is a cogroup with the owner's posting lists that adds integer contributions.
An accumulator goes only if the terms still to come cannot lift it to the ``k``-th best
score that its item has reached in the block, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwake.llm.common import slices, text_of
from cartwake.sources.files import stored

#: Documents and terms with repeats after which a block is closed; a longer document ends one.
BLOCK_DOCS = 16_384
BLOCK_TERMS = 4_000_000
#: Items of a bundle: the bits of an item number that tell items of a bundle apart.
BUNDLE_BITS = 7
#: A term in fewer than this share of the documents belongs to the owner of this place.
OWNERS = (1 / 256, 1 / 32, 1 / 8, 2.0)
#: No contribution reaches this times the term's weight.
MOST = 1_000_000

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

INDEX = "block long, term string, df long, total long, docs binary, counts binary, ids array<long>"


def terms(text: str) -> Column:
    """The terms of a text in order, A-Z lowered; null has none."""
    return F.regexp_extract_all(F.translate(text_of(text), UPPER, LOWER), F.lit(TERM), F.lit(0))


def _fold() -> bytes:
    """The same terms byte by byte: lower letters, blanks for what parts terms."""
    return bytes(ord(c.lower()) if c.isalnum() or b > 127 else 32 for b, c in enumerate(map(chr, range(128)))) + bytes(range(128, 256))


# -- index ------------------------------------------------------------------
class _Block:
    def __init__(self, number: int):
        self.number, self.words, self.ids = number, {}, []
        self.codes: list[np.ndarray] = []
        self.sizes: list[int] = []

    def add(self, doc_id: int | None, codes: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(codes))
        self.codes.append(codes)

    def rows(self) -> pa.RecordBatch:
        """A posting list per term, and under the empty term all documents and their sizes."""
        # Places follow the ids, so ties between documents are ties of places.
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        ids = [self.ids[i] for i in order]
        sizes = np.array([self.sizes[i] for i in order], dtype=np.int64)
        codes = np.concatenate([self.codes[i] for i in order]).astype(np.int64)
        docs = np.repeat(np.arange(len(sizes)), sizes)
        pairs, counts = np.unique(codes * len(sizes) + docs, return_counts=True)
        term, doc = np.divmod(pairs, len(sizes))
        ends = np.concatenate([[0], np.flatnonzero(np.diff(term)) + 1, [len(term)]]) if len(term) else np.zeros(1, np.int64)
        n = len(ends) - 1
        words = sorted(self.words, key=self.words.get)
        lists = [
            pa.array([self.number] * (n + 1), pa.int64()),
            pa.array([*words, b""], pa.binary()).cast(pa.string()),
            pa.array([*np.diff(ends).tolist(), int((sizes > 0).sum())], pa.int64()),
            pa.array([*np.add.reduceat(counts, ends[:-1]).tolist(), int(sizes.sum())] if n else [int(sizes.sum())], pa.int64()),
            _binary(doc.astype("<u2"), ends, b""),
            _binary(counts.astype("<i4"), ends, sizes.astype("<i8").tobytes()),
            pa.array([None] * n + [ids], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(lists, ["block", "term", "df", "total", "docs", "counts", "ids"])


def _binary(values: np.ndarray, ends: np.ndarray, last: bytes) -> pa.Array:
    """Stretches of an array as binary values, and one more value."""
    data = values.tobytes() + last
    offsets = np.append(ends * values.itemsize, len(data)).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Posting lists of every whole text, in the shared folder.

    A row per block and term: ``docs`` are 16-bit places in the block, ``counts`` 32-bit
    occurrences, ``df`` and ``total`` their number and sum.  The row of the empty term has
    the block's documents: ``ids``, their sizes (64 bits), ``df`` those with a term and
    ``total`` all terms.  Every row of ``docs`` is a document of its own, also without an
    id; null texts have no terms.  Other columns are not read.
    """
    fold = _fold()

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        block, held = _Block(part << 32), 0
        for batch in slices(batches, "text"):
            found = [t.translate(fold).split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            flat = pa.array([t for d in found for t in d], pa.binary()).dictionary_encode()
            names, at = flat.dictionary.to_pylist(), flat.indices.to_numpy()
            of_block = None
            first = 0
            for d, f in zip(batch.column("doc_id").to_pylist(), found):
                if block.ids and (len(block.ids) == BLOCK_DOCS or held + len(f) > BLOCK_TERMS):
                    yield block.rows()
                    number += 1
                    block, held, of_block = _Block((part << 32) + number), 0, None
                if of_block is None:
                    of_block = np.full(len(names), -1, dtype=np.int32)
                here = at[first : first + len(f)]
                for i in np.unique(here[of_block[here] < 0]).tolist():
                    of_block[i] = block.words.setdefault(names[i], len(block.words))
                block.add(d, of_block[here])
                first, held = first + len(f), held + len(f)
        if block.ids:
            yield block.rows()

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(f"`{text}`").alias("text"))
    return stored(rows.mapInArrow(post, INDEX), "postings")


# -- search -----------------------------------------------------------------
def search(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", k: int = 50) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of each item.

    Only scores above 0 count; equal scores stand by ascending doc_id, documents without an
    id last, repeated rows in a row.  Every row of ``items`` is an item of its own, ranked
    by itself, also where ids repeat or are null; items without terms have no rows.

    N documents have a term, L is all their terms, n a document's.  A term in df documents
    weighs w = floor(1000 ln((2N+2)/(2df+1))) and adds w * (10^9 tf div (1000 tf + 20 m)),
    m = 50 + 50 n N div L, all in 64-bit integers.
    """
    empty = F.col("term") == ""
    n_docs, n_terms = index.where(empty).agg(F.sum("df"), F.sum("total")).first()
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.array_distinct(terms(f"`{text}`")).alias("terms"))
    # Numbers are given once, to a stored table.
    asked = stored(asked.where(F.size("terms") > 0).withColumn("item", F.monotonically_increasing_id()), "items")
    wanted = asked.select(
        F.shiftright("item", BUNDLE_BITS).alias("bundle"),
        F.col("item").bitwiseAND((1 << BUNDLE_BITS) - 1).cast("int").alias("slot"),
        F.explode("terms").alias("term"),
    )
    found = index.join(wanted.select("term").distinct(), "term", "left_semi")
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs or 0) + 2) / (2 * F.col("df") + 1)))
    share = F.col("df") / F.lit(n_docs or 1)
    owner = F.coalesce(*[F.when(share < s, F.lit(i)) for i, s in enumerate(OWNERS)])
    weighed = found.groupBy("term").agg(F.sum("df").alias("df")).select("term", weight.alias("weight"), owner.alias("owner"))
    weighed = stored(wanted.join(weighed, "term"), "weights")
    uses = weighed.groupBy("bundle", "term", "owner", "weight").agg(F.collect_list("slot").alias("slots"))
    lists = stored(found.select("block", "term", "docs", "counts"), "lists")

    # What the terms of later owners can still add to an item.
    to_come = [F.sum(F.when(F.col("owner") > o, F.col("weight")).otherwise(0)).alias(f"r{o}") for o in range(len(OWNERS))]
    rest = weighed.groupBy("bundle", "slot").agg(*to_come)
    rest = rest.groupBy("bundle").agg(F.collect_list(F.struct("slot", *[f"r{o}" for o in range(len(OWNERS))])).alias("rest"))
    # A bundle visits the blocks that hold one of its terms.
    visits = lists.select("block", "term").join(uses.select("bundle", "term"), "term").select("block", "bundle").distinct()
    state = (
        index.where(empty).select("block", "counts").join(visits, "block").join(rest, "bundle")
        .select("bundle", "block", F.col("counts").alias("sizes"), "rest", F.lit(None).cast(HELD).alias("held"))
    )
    for o in range(len(OWNERS)):
        posts = lists.join(uses.where(F.col("owner") == o), "term").select(
            F.col("bundle").alias("bundle"), F.col("block").alias("block"), "weight", "slots", "docs", "counts"
        )
        state = state.groupBy("bundle", "block").cogroup(posts.groupBy("bundle", "block")).applyInArrow(
            _stage(o, n_docs or 0, n_terms or 1, k), STATE
        )
    best = state.select("bundle", "block", F.explode("held").alias("h")).select(
        (F.shiftleft("bundle", BUNDLE_BITS) + F.col("h.slot")).alias("item"), "block",
        F.explode(F.arrays_zip(F.col("h.docs").alias("place"), F.col("h.scores").alias("score"))).alias("hit"),
    ).select("item", "block", "hit.*")
    ids = index.where(empty).select("block", F.posexplode("ids").alias("place", "doc_id"))
    best = best.join(ids, ["block", "place"]).select("item", "doc_id", "score")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


#: Of each item of a bundle the places of its documents in the block and their scores.
HELD = "array<struct<slot:int,docs:array<int>,scores:array<long>>>"
_REST = "array<struct<slot:int," + ",".join(f"r{o}:long" for o in range(len(OWNERS))) + ">>"
_REST_ARROW = pa.list_(pa.struct([("slot", pa.int32()), *((f"r{o}", pa.int64()) for o in range(len(OWNERS)))]))
STATE = f"bundle long, block long, sizes binary, rest {_REST}, held {HELD}"


def _stage(owner: int, n_docs: int, n_terms: int, k: int):
    """One owner's visit: its contributions are added to the accumulators of a bundle."""

    def visit(state: pa.Table, posts: pa.Table) -> pa.Table:
        if not state.num_rows:
            return state
        sizes = np.frombuffer(state.column("sizes")[0].as_py(), "<i8")
        least = 20 * (50 + 50 * sizes * n_docs // n_terms)
        # Each item's terms of this owner.
        terms: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for w, slots, docs, counts in zip(*(posts.column(c).to_pylist() for c in ("weight", "slots", "docs", "counts"))):
            at, tf = np.frombuffer(docs, "<u2"), np.frombuffer(counts, "<i4").astype(np.int64)
            adds = w * (1_000_000_000 * tf // (1000 * tf + least[at]))
            for s in slots:
                terms.setdefault(s, []).append((at, adds))
        held = {}
        old = state.column("held").combine_chunks().flatten()
        if len(old):
            slots, places, scores = old.field("slot").to_pylist(), old.field("docs"), old.field("scores")
            held = {s: (places[i].values.to_numpy(), scores[i].values.to_numpy()) for i, s in enumerate(slots)}
        rest = {r["slot"]: r[f"r{owner}"] * MOST for r in state.column("rest")[0].as_py()}
        total = np.zeros(len(sizes), dtype=np.int64)
        out_slots, out_docs, out_scores = [], [], []
        for slot in sorted(held.keys() | terms.keys()):
            touched = []
            if slot in held:
                at, had = held[slot]
                total[at] = had
                touched.append(at)
            for at, adds in terms.get(slot, ()):
                total[at] += adds
                touched.append(at)
            at = np.unique(np.concatenate(touched))
            score = total[at]
            total[at] = 0
            if owner == len(OWNERS) - 1:
                # The k best of the block, of equal ones the first.
                keep = np.lexsort((at, -score))[:k]
                keep = keep[score[keep] > 0]
            else:
                keep = _may_win(score, rest[slot], k)
            if len(keep):
                out_slots.append(slot)
                out_docs.append(at[keep].astype(np.int32))
                out_scores.append(score[keep])
        ends = np.cumsum([0] + [len(d) for d in out_docs]).astype(np.int32)
        items = pa.StructArray.from_arrays(
            [
                pa.array(out_slots, pa.int32()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out_docs) if out_docs else [], pa.int32())),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out_scores) if out_scores else [], pa.int64())),
            ],
            ["slot", "docs", "scores"],
        )
        held = pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items)
        kept = [state.column(c) for c in ("bundle", "block", "sizes")]
        return pa.table([*kept, state.column("rest").cast(_REST_ARROW), held], ["bundle", "block", "sizes", "rest", "held"])

    return visit


def _may_win(score: np.ndarray, rest: int, k: int) -> np.ndarray:
    """Documents that can still be among the ``k`` best, or tie with the last of them."""
    if len(score) <= k:
        return np.arange(len(score))
    return np.flatnonzero(score + rest >= np.partition(score, -k)[-k])
