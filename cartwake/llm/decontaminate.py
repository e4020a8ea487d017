"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Texts are normalised (A-Z lower, every ASCII character that is no letter or digit is a
break) and each text is scanned once for all windows of all items.  Hits are mapped back
to character offsets of the original text.

Items are cut into pieces that overlap by a window less a word, and shipped to the tasks in
blocks of about ``BLOCK_BYTES`` of text; more than one block means one more pass over the
documents each, so no broadcast grows unchecked.  The automaton steps from word to word, a
word of a block being one sign, and a worker keeps that of one block for its next tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwake.llm.common import others, per_text, slices
from cartwake.sources.files import stored

WINDOW = 13
#: A window per word and a node per word of a window: about 0.3 GB a worker at most.
BLOCK_BYTES = 1 << 20
#: Windows of a piece of an item.
PIECE = 4096
#: Words of a block are signs from here on, above the surrogates; others are ``_OTHER``.
_FIRST_SIGN, _OTHER = 0xE000, "\x01"

_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32
    for c in range(256)
)

RUNS, ITEMS, SPANS = "hit_runs", "hit_items", "hit_spans"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; bytes above 127 always belong to a word."""
    return (text or "").encode("utf-8", "replace").translate(_NORMAL).split()


class Windows:
    """The automaton of a block of items."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.signs: dict[bytes, str] = {}
        found: dict[str, tuple[int, set[str]]] = {}
        for item, text in items:
            words = words_of(text)
            for w in words:
                if w not in self.signs:
                    self.signs[w] = chr(_FIRST_SIGN + len(self.signs))
            line, size = self._signs_of(words), min(window, len(words))
            for i in range(len(words) - size + 1) if words else ():
                found.setdefault(line[i : i + size], (size, set()))[1].add(item)
        self.machine = ahocorasick.Automaton()
        for key, value in found.items():
            self.machine.add_word(key, value)
        self.empty = not found
        if found:
            self.machine.make_automaton()

    def _signs_of(self, words: list[bytes]) -> str:
        return "".join(map(self.signs.get, words, repeat(_OTHER)))

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of word places (first, past the last) in any window, and the items."""
        if self.empty or not words:
            return [], set()
        found = [(end + 1 - n, end + 1, ids) for end, (n, ids) in self.machine.iter(self._signs_of(words))]
        if not found:
            return [], set()
        return merge_runs([f[:2] for f in found]), set().union(*(f[2] for f in found))


_KEPT: dict[str, Windows] = {}


def windows_of(key: str, items, window: int) -> Windows:
    """The automaton of the block of this key; a worker keeps the last one."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Windows(items.value, window)
    return _KEPT[key]


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def offsets(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets of word runs in the original text."""
    if not runs:
        return []
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    word = np.frombuffer(raw.tobytes().translate(_NORMAL), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    char = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    starts, ends = char[edge[::2]], char[edge[1::2]]
    return [(int(starts[a]), int(ends[b - 1])) for a, b in runs]


def _pieces(items: DataFrame, window: int) -> DataFrame:
    """``id`` and ``text`` of pieces of items; every window of an item lies in one of them."""

    def work():
        def cut(text: str) -> list[str]:
            words = [w.decode("utf-8", "replace") for w in words_of(text)]
            starts = range(0, max(1, len(words) - window + 1), PIECE) if words else ()
            return [" ".join(words[i : i + PIECE + window - 1]) for i in starts]

        return lambda texts: [pa.array([cut(t) for t in texts], pa.list_(pa.string()))]

    found = per_text(items, "text", ["id"], {"pieces": T.ArrayType(T.StringType())}, work)
    return found.select("id", F.explode("pieces").alias("text"))


def _pass(docs: DataFrame, items: list[tuple[str, str]], window: int, last: bool) -> DataFrame:
    """One scan of the documents for one block of items."""
    again = RUNS in docs.columns
    key = hashlib.sha256(repr((window, sorted(items))).encode("utf-8", "replace")).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(items)  # about a block
    pair = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    arrow_pair = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    new = [("n_words", T.LongType()), ("n_hit", T.LongType()), (RUNS, pair), (ITEMS, T.ArrayType(T.StringType()))]
    new += [(SPANS, pair)] if last else []
    kept = [c for c in docs.columns if c not in {n for n, _ in new} and not (last and c == "text")]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, t) for n, t in new])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = windows_of(key, shared, window)
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            before = batch.column(RUNS).to_pylist() if again else [[]] * len(texts)
            known = batch.column(ITEMS).to_pylist() if again else [[]] * len(texts)
            n_words, runs, ids = [], [], []
            for t, r, k in zip(texts, before, known):
                words = words_of(t)
                got, names = machine.hits(words)
                n_words.append(len(words))
                runs.append(merge_runs(got + [(x["start"], x["stop"]) for x in r]) if r else got)
                ids.append(sorted(names.union(k)))
            out = [batch.column(c) for c in kept] + [
                pa.array(n_words, pa.int64()),
                pa.array([sum(b - a for a, b in r) for r in runs], pa.int64()),
                _pairs(runs, arrow_pair),
                pa.array(ids, pa.list_(pa.string())),
            ]
            if last:
                out.append(_pairs([offsets(t or "", r) for t, r in zip(texts, runs)], arrow_pair))
            yield pa.RecordBatch.from_arrays(out, schema.names)

    return docs.mapInArrow(scan, schema)


def _pairs(rows: list[list[tuple[int, int]]], kind: pa.DataType) -> pa.Array:
    return pa.array([[{"start": a, "stop": b} for a, b in r] for r in rows], kind)


def scan(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Mark the words of documents that lie in a window of an item.

    A window is ``window`` consecutive words of an item, or all of a shorter item that
    has words.  Adds to the ``keep`` columns (all by default): n_words, n_hit,
    hit_runs (word places), hit_items (item ids as sorted strings), hit_spans (offsets
    in the original text) and contaminated: at least a twentieth of the words are hit.
    Columns of these names in ``docs``, in any case, are replaced.

    Null texts have no words.  An item without an id hits like any other and is listed
    as the empty string; rows of one item id count as one item.  Without items, or with
    items that have no words, nothing is hit.  Repeated rows stay.
    """
    rows = items.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{item_text}`").alias("text")
    ).where(F.col("text").isNotNull())
    rows = stored(_pieces(rows, window), "benchmark-pieces")
    size = rows.agg(F.sum(F.octet_length("text") + F.octet_length("id") + 1)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    added = ["n_words", "n_hit", RUNS, ITEMS, SPANS]
    keep = others(docs.columns if keep is None else keep, [*added, "contaminated"])
    # Names of the user's may hold dots or differ in case alone: numbers stand in.
    out = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("text"))
    for k in range(blocks):
        block = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        part = [(r.id, r.text) for r in block.collect()]  # about block_bytes
        last = k == blocks - 1
        out = _pass(out, part, window, last)
        if not last:
            out = stored(out, "contamination")
    bad = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return out.withColumn("contaminated", bad).toDF(*keep, *added, "contaminated")
