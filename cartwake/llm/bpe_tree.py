"""BPE ids of texts of any length by tree concatenation, and their text again.

A long text is normalised and matched once, which is linear, and becomes one row of
symbols in which a blank ends a piece.  The row is halved, anywhere, until a leaf is short;
leaves of all texts are encoded in parallel.  Then neighbours are joined in a tree: a
window of tokens around each join is encoded again, and grows on the side where its first
or last token is not the one that side had, until both sides agree.

That is exact: in rank order with ties to the left, a row of tokens is the encoding of its
symbols if every two neighbours are the encoding of theirs.  Neighbours inside a side or
inside the window are; a window that begins with a token of the left side has the
neighbour before it that this token had there, and so on the right.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwake.llm.common import slices, text_of
from cartwake.llm.token_codes import _encoder, as_bytes, blanks_only, piece_tokenizer

#: Symbols of a leaf; texts of no more characters are encoded at once.
LEAF = 16_384
#: Tokens on each side of a join that the first window holds.
WINDOW = 8


class TreeEncoder:
    """Symbols, leaves and joins of one vocabulary."""

    def __init__(self, path: str):
        self.words = _encoder(path)
        self.whole, self.open = self.words.pieces, piece_tokenizer(path, ends=False)
        self.plain = re.compile(self.words.plain)
        special = self.words.special
        self.any_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        vocab = self.whole.get_vocab()
        # Symbols of each token; a blank where a piece ends.
        self.symbols = [""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.symbols[i] = t[:-4] + " " if t.endswith("</w>") else t

    def row(self, text: str) -> str:
        """The text as symbols, each piece with a blank behind it."""
        words = blanks_only(text).split(" ")
        rows = {w: self._row(w) for w in set(words)}
        return "".join([rows[w] for w in words])

    def _row(self, word: str) -> str:
        if found := self.plain.match(word):
            # Visible ASCII stands for itself.
            return "".join([(p if p.isascii() else as_bytes(p)) + " " for p in found.groups() if p])
        out = []
        for part in self.any_special.split(word) if self.any_special else [word]:
            if part in self.words.special:
                out.append(self.words.special[part])
            elif part:
                shown = self.words.model.normalizer.normalize_str(part)
                out += [p for p, _ in self.words.model.pre_tokenizer.pre_tokenize_str(shown)]
        return "".join([p + " " for p in out])

    def encode(self, row: str) -> list[int]:
        """Ids of a stretch of a row; its last piece may be cut."""
        cut = row.rfind(" ") + 1
        ids = self.whole.encode_batch_fast([row[:cut]], add_special_tokens=False)[0].ids if cut else []
        if cut < len(row):
            ids = ids + self.open.encode_batch_fast([row[cut:]], add_special_tokens=False)[0].ids
        return ids

    def join(self, left: list[int], right: list[int], window: int = WINDOW) -> list[int]:
        """The ids of two neighbouring stretches as one."""
        a = b = window
        while left and right:
            a, b = min(a, len(left)), min(b, len(right))
            ids = self.encode("".join([self.symbols[i] for i in left[-a:] + right[:b]]))
            left_agrees = a == len(left) or ids[0] == left[-a]
            right_agrees = b == len(right) or ids[-1] == right[b - 1]
            if left_agrees and right_agrees:
                return left[:-a] + ids + right[b:]
            a, b = a if left_agrees else 2 * a, b if right_agrees else 2 * b
        return left or right

    def tree(self, parts: list[list[int]], window: int = WINDOW) -> list[int]:
        """Leaves in order, joined two by two."""
        while len(parts) > 1:
            pairs = [self.join(a, b, window) for a, b in zip(parts[::2], parts[1::2])]
            parts = pairs + parts[2 * len(pairs) :]
        return parts[0] if parts else []


def halves(row: str, leaf: int) -> list[str]:
    """A row halved until its parts have ``leaf`` symbols or fewer.

    A blank stays with the symbol whose piece it ends.
    """
    parts = [row]
    while max(map(len, parts)) > max(leaf, 2):
        cut = []
        for p in parts:
            m = len(p) // 2
            m += p[m : m + 1] == " "
            cut += [p[:m], p[m:]]
        parts = [p for p in cut if p]
    return parts


@lru_cache(maxsize=2)
def _tree_encoder(path: str) -> TreeEncoder:
    """One encoder for all tasks of a worker."""
    return TreeEncoder(path)


def _bytes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def encode(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
    leaf: int = LEAF, window: int = WINDOW,
) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit numbers) of every whole text.

    Special tokens are matched in the text, none are added.  Null texts are empty and have
    no ids.  Every row gives a row: repeats and rows without an id too.  Other columns are
    not read.  Texts above ``leaf`` characters leave their task as leaves; one task then
    joins the ids of one text, four bytes a token.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(f"`{text}`").alias("text"))
    short = rows.where(F.length("text") <= leaf)
    # Equal rows are encoded once.
    long = rows.where(F.length("text") > leaf).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    long = long.withColumn("key", F.sha2("text", 256))

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _encoder(tokenizer)
        for batch in slices(batches, "text"):
            ids = words.texts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _tree_encoder(tokenizer)
        for batch in slices(batches, "text"):
            for i, t in enumerate(batch.column("text")):
                parts = halves(tree.row(t.as_py()), leaf)
                n = pa.array(np.full(len(parts), i))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(n) for c in own), pa.array(np.arange(len(parts))), pa.array(parts, pa.string())],
                    [*own, "leaf", "row"],
                )

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _tree_encoder(tokenizer)
        for batch in slices(batches, "row"):
            ids = [_bytes(tree.encode(r)) for r in batch.column("row").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in [*own, "leaf"]), pa.array(ids, pa.binary())], [*own, "leaf", "ids"]
            )

    def joined(group: pa.Table) -> pa.Table:
        tree = _tree_encoder(tokenizer)
        group = group.sort_by("leaf")
        parts = [np.frombuffer(b.as_py(), "<u4").tolist() for b in group.column("ids")]
        ids = pa.array([_bytes(tree.tree(parts, window))], pa.binary())
        return pa.table([*(group.column(c).slice(0, 1) for c in own[:2]), ids], ["doc_id", "copies", "ids"])

    own, kinds = ["doc_id", "copies", "key"], "doc_id long, copies long, key string"
    long = long.mapInArrow(cut, f"{kinds}, leaf long, row string").repartition("key", "leaf")
    long = long.mapInArrow(leaves, f"{kinds}, leaf long, ids binary")
    long = long.groupBy("doc_id", "key").applyInArrow(joined, "doc_id long, copies long, ids binary")
    long = long.select("doc_id", F.explode(F.array_repeat("ids", F.col("copies").cast("int"))).alias("ids"))
    return short.mapInArrow(at_once, "doc_id long, ids binary").unionByName(long)


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in ``into``, a blank between tokens.

    This vocabulary names no decoder, so tokens stand as they are written in it, special
    ones too.  Ids that it does not have give nothing; null ids give the empty text.
    """

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _token_texts(tokenizer)
        for batch in slices(batches, ids):
            raw = [b or b"" for b in batch.column(ids).to_pylist()]
            flat = np.frombuffer(b"".join(raw), dtype="<u4")
            known = flat < len(tokens)
            ends = np.concatenate([[0], np.cumsum(known)])[np.cumsum([0] + [len(b) // 4 for b in raw])]
            words = tokens.take(pa.array(flat[known]))
            text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), words), pa.scalar(" ", pa.large_string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, text.cast(pa.string())], [*batch.schema.names, into])

    from pyspark.sql.types import StringType, StructField, StructType

    return encoded.mapInArrow(back, StructType([*encoded.schema.fields, StructField(into, StringType())]))


@lru_cache(maxsize=2)
def _token_texts(path: str) -> pa.Array:
    from tokenizers import Tokenizer

    vocab = Tokenizer.from_file(path).get_vocab()
    texts = [None] * (max(vocab.values()) + 1)
    for t, i in vocab.items():
        texts[i] = t
    if None in texts:
        raise ValueError("the ids of the vocabulary have gaps")
    return pa.array(texts, pa.large_string())
