"""Token ids as directly addressable codes in shard files.

An id is split into chunks of eight bits.  Level 0 holds the lowest chunk of every id
and a bitmap that says which ids go on; level 1 holds the next chunk of those that do,
and so on.  A rank directory over each bitmap finds the place of an id's next chunk, so
any token is read without decoding a block.

A shard is one file, all numbers little-endian:

    "DAC1", u32 partition, u32 number in the partition, u32 levels, u64 documents, u64 tokens
    documents x (u8 has id, i64 id), (documents + 1) x u64 first token
    per level: u64 entries, entries x u8 chunk, bitmap (lowest bit first),
               u32 rank for every 512 bits
    "\\n"

Spark writes the files, so failed tasks leave nothing behind and any store it knows will do.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwake.llm.common import slices
from cartwake.sources.files import shared_folder, stored

MAGIC = b"DAC1"
HEADER = struct.Struct("<4sIIIQQ")
RANK_BITS = 512
#: Tokens after which a shard is closed; a longer document has a shard of its own.
SHARD_TOKENS = 2_000_000
#: Text whose different words are encoded in one call.
SLICE_BYTES = 8 << 20
#: Words that go to the library at a time; it needs some hundred bytes for each of their tokens.
CALL_WORDS = 16_384


# -- the code ---------------------------------------------------------------
def pack(ids: np.ndarray, chunks: int | None = None) -> bytes:
    """The levels of an array of ids below 2**32."""
    rest, out = np.asarray(ids, dtype="<u4"), []
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        blocks = np.arange(0, len(bits), RANK_BITS // 8)
        counts = np.add.reduceat(np.bitwise_count(bits), blocks, dtype=np.int64) if len(bits) else blocks
        ranks = (np.cumsum(counts) - counts).astype("<u4")
        out.append(struct.pack("<Q", len(rest)) + rest.astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[more] >> 8
        if not len(rest):
            return struct.pack("<I", len(out)) + b"".join(out)


class Shard:
    """Random access to one shard's documents and tokens."""

    def __init__(self, data: bytes):
        magic, self.partition, self.number, levels, docs, tokens = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard of token codes")
        at = HEADER.size
        self.n_docs, self.n_tokens = docs, tokens
        self.known = np.frombuffer(data, np.uint8, docs, at)
        self.ids = np.frombuffer(data, "<i8", docs, at + docs)
        at += 9 * docs
        self.starts = np.frombuffer(data, "<u8", docs + 1, at).astype(np.int64)
        at += 8 * (docs + 1)
        self.levels = []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            size, blocks = (n + 7) // 8, (n + RANK_BITS - 1) // RANK_BITS
            self.levels.append((
                np.frombuffer(data, np.uint8, n, at),
                np.frombuffer(data, np.uint8, size, at + n),
                np.frombuffer(data, "<u4", blocks, at + n + size),
            ))
            at += n + size + 4 * blocks
        if data[at:] != b"\n":
            raise ValueError("a shard of token codes is cut short")

    @staticmethod
    def _rank(level, i: int) -> int:
        """Set bits before position ``i``."""
        _, bits, ranks = level
        block = i // RANK_BITS
        whole = bits[block * RANK_BITS // 8 : i // 8]
        last = int(bits[i // 8]) & ((1 << (i % 8)) - 1) if i % 8 else 0
        return int(ranks[block]) + int(np.bitwise_count(whole).sum()) + last.bit_count()

    def token(self, i: int) -> int:
        """The id at position ``i``, found by rank alone."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = shift = 0
        for level in self.levels:
            chunk, bits, _ = level
            value |= int(chunk[i]) << shift
            if not bits[i // 8] >> (i % 8) & 1:
                break
            i, shift = self._rank(level, i), shift + 8
        return value

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range of positions."""
        out, at, a, b = np.zeros(stop - start, dtype="<u4"), None, start, stop
        for k, level in enumerate(self.levels):
            chunk, bits, _ = level
            if b <= a:
                break
            part = chunk[a:b].astype("<u4") << (8 * k)
            if at is None:
                out |= part
            else:
                out[at] |= part
            more = np.flatnonzero(
                np.unpackbits(bits[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a]
            )
            if not len(more):
                break
            first = self._rank(level, a)
            at = more if at is None else at[more]
            a, b = first, first + len(more)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.tokens(self.starts[k], self.starts[k + 1])


def _shard(partition: int, number: int, docs: list[int | None], parts: list[bytes]) -> bytes:
    sizes = np.array([len(p) // 4 for p in parts], dtype="<u8")
    starts = np.zeros(len(parts) + 1, dtype="<u8")
    np.cumsum(sizes, out=starts[1:])
    levels = pack(np.frombuffer(b"".join(parts), dtype="<u4"))
    head = HEADER.pack(MAGIC, partition, number, struct.unpack_from("<I", levels)[0], len(docs), int(starts[-1]))
    known = np.array([d is not None for d in docs], dtype=np.uint8)
    ids = np.array([d or 0 for d in docs], dtype="<i8")
    return head + known.tobytes() + ids.tobytes() + starts.tobytes() + levels[4:] + b"\n"


# -- tokens -----------------------------------------------------------------
#: One-letter pieces that stand for special tokens among pieces.
MARK = 0xE000


def piece_tokenizer(path: str, ends: bool = True, marks: dict[str, str] | None = None):
    """The merges of a byte-level BPE file alone, over pieces that stand between blanks.

    Pieces are in the file's byte alphabet (``as_bytes``), so nothing is normalised or
    matched again.  ``ends`` says whether a piece's last symbol carries the word end;
    ``marks`` gives special tokens a one-letter piece.
    """
    from tokenizers import Tokenizer, models, pre_tokenizers

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, marks = file["model"], marks or {}
    end = model.get("end_of_word_suffix") or ""
    if model["type"] != "BPE" or not end:
        raise ValueError("needs a byte-level BPE file whose pieces have word ends")
    vocab = {t: i for t, i in model["vocab"].items() if t not in marks}
    vocab |= {marks[t["content"]]: t["id"] for t in file["added_tokens"] if t["content"] in marks}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    out = Tokenizer(models.BPE(vocab, merges, **({"end_of_word_suffix": end} if ends else {})))
    out.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
    return out


def _byte_letters() -> np.ndarray:
    # Visible bytes stand for themselves, the others follow from 256 on; blanks stay.
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = np.zeros(256, dtype="<u4")
    letters[shown] = shown
    hidden = np.flatnonzero(letters == 0)
    letters[hidden] = 256 + np.arange(len(hidden))
    letters[0x20] = 0x20
    return letters


_BYTE_LETTERS = _byte_letters()


def _plain_word() -> str:
    """Letters that nothing composes or lowers, then marks; either may be missing."""
    letters = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c.lower() == c)
    marks = "".join("\\" + c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")
    return f"^(?P<stem>[{letters}]*)(?P<tail>[{marks}]*)$"


def as_bytes(text: str) -> str:
    """The UTF-8 bytes of a text in the byte alphabet; blanks stay."""
    return _BYTE_LETTERS[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")


class Encoder:
    """Ids of whole texts, word by word.

    The vocabulary's pre-tokenizer never joins text across ASCII white space, so the ids
    of a text are those of its words in a row.  The words of a batch are dictionary-encoded
    and each different one is encoded once.  Letters and the marks behind them are a piece
    each, which need the merges alone and one call for all; other words take the whole way.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.special = {t.content: chr(MARK + k) for k, t in enumerate(self.model.get_added_tokens_decoder().values())}
        self.pieces = piece_tokenizer(path, marks={t: f"{m}</w>" for t, m in self.special.items()})
        vocab = self.model.get_vocab()
        # A token that ends with this suffix ends a piece of the pre-tokenizer.
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.plain = _plain_word()

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """First token of each word (and the end), and the ids of all words in a row."""
        found = pc.extract_regex(words, self.plain)
        stem, tail = found.field("stem"), found.field("tail")
        joined = pc.binary_join_element_wise(stem, tail, pa.scalar(" ", stem.type)).drop_null().to_pylist()
        calls = [as_bytes(" ".join(joined[i : i + CALL_WORDS])) for i in range(0, len(joined), CALL_WORDS)]
        ids = np.concatenate([np.zeros(0, "<u4"), *(_ids(self.pieces.encode_batch_fast([c], add_special_tokens=False)[0]) for c in calls)])
        n_pieces = sum(pc.fill_null(pc.not_equal(part, ""), False).to_numpy(False).astype(np.int64) for part in (stem, tail))
        piece_ends = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        word_ends = piece_ends[np.cumsum(n_pieces)]
        sizes = np.diff(word_ends, prepend=0)
        odd = np.flatnonzero(found.is_null().to_numpy(False))
        if not len(odd):
            return np.concatenate([[0], word_ends]), ids
        other = [_ids(e) for e in self.model.encode_batch_fast(words.take(pa.array(odd)).to_pylist(), add_special_tokens=False)]
        others = np.fromiter(map(len, other), np.int64, len(other))
        sizes[odd] = others
        # Ids of other words go between those that were found in one call.
        ids = np.insert(ids, np.repeat(word_ends[odd], others), np.concatenate(other))
        return np.concatenate([[0], np.cumsum(sizes)]), ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First token of each text (and the end), and the ids of all texts in a row."""
        words = pc.split_pattern(pa.array(list(map(blanks_only, texts)), pa.large_string()), " ")
        flat = words.flatten().dictionary_encode()
        if not len(flat):
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, "<u4")
        starts, ids = self._words(flat.dictionary)
        at = flat.indices.to_numpy()
        counts = np.diff(starts)[at]
        ends = np.cumsum(counts)
        place = np.repeat(starts[at] - ends + counts, counts) + np.arange(ends[-1])
        return np.concatenate([[0], ends])[words.offsets.to_numpy()], ids[place]

    def texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit bytes."""
        starts, ids = self.encode(texts)
        data, at = ids.tobytes(), (starts * 4).tolist()
        return [data[a:b] for a, b in zip(at, at[1:])]


def _ids(encoding) -> np.ndarray:
    return np.array(encoding.ids, dtype="<u4")


def blanks_only(text: str) -> str:
    """The text with blanks for ASCII white space, in lower case where that is safe."""
    return _lower(text).replace("\n", " ").replace("\t", " ").replace("\r", " ")


def _lower(text: str) -> str:
    """The text in lower case where that cannot change its ids.

    The vocabulary composes characters first and lowers them one by one then, and its
    special tokens are matched as they are written.
    """
    if "<|" in text or "\u03a3" in text:
        return text
    low = text.lower()
    if text.isascii() or is_normalized("NFC", text) and is_normalized("NFC", low):
        return low
    return text


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path)


# -- the job ----------------------------------------------------------------
def write_codes(
    docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 1,
    doc_id: str = "doc_id", text: str = "text", shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode every text and write shards in ascending document order.

    Null texts count as empty: they have the end id only.  Documents without an id come
    first; equal ids stand in the order of their texts' hashes.  Other columns are not
    read.  An empty table writes no shard.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        end = b"" if end_id is None else struct.pack("<I", end_id)
        ids, parts, held, number = [], [], 0, 0

        def shard():
            return pa.RecordBatch.from_arrays([pa.array([_shard(part, number, ids, parts)], pa.binary())], ["shard"])

        for batch in slices(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for d, p in zip(batch.column("doc_id").to_pylist(), encoder.texts(texts)):
                if held and held + len(p) // 4 > shard_tokens:
                    yield shard()
                    ids, parts, held, number = [], [], 0, number + 1
                ids.append(d)
                parts.append(p + end)
                held += len(p) // 4 + 1
        if ids:
            yield shard()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = rows.mapInArrow(encode, "shard binary")
    shards.select(F.col("shard").substr(F.lit(1), F.length("shard") - 1).cast("string")).write.option(
        "maxRecordsPerFile", 1
    ).text(path)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the shards at ``path``.

    Columns: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the
    ids as little-endian 32-bit numbers), and where it lies: partition, shard, position.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                s = Shard(data.as_buffer().to_pybytes())
                ids = s.tokens(0, s.n_tokens).tobytes()
                at = (s.starts * 4).tolist()
                crcs = [zlib.crc32(memoryview(ids)[a:b]) for a, b in zip(at, at[1:])]
                n = s.n_docs
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(s.ids, mask=s.known == 0),
                        pa.array(s.starts[:-1]),
                        pa.array(np.diff(s.starts)),
                        pa.array(crcs, pa.int64()),
                        pa.array(np.full(n, s.partition, np.int64)),
                        pa.array(np.full(n, s.number, np.int64)),
                        pa.array(np.arange(n, dtype=np.int64)),
                    ],
                    ["doc_id", "local", "n_tokens", "ids_crc32", "partition", "shard", "position"],
                )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    docs = stored(
        files.mapInArrow(
            decode,
            "doc_id long, local long, n_tokens long, ids_crc32 long, partition long, shard long, position long",
        ),
        "codes",
    )
    # One row per shard, so a single window is small: a million shards hold 2e12 tokens.
    before = Window.orderBy("partition", "shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = docs.groupBy("partition", "shard").agg(F.sum("n_tokens").alias("n")).select(
        "partition", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    return docs.join(bases, ["partition", "shard"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32",
        "partition", "shard", "position",
    )


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int | None = 1) -> DataFrame:
    """Write the shards of ``docs`` to the shared folder and read them back."""
    path = shared_folder(docs.sparkSession, "token-codes")
    write_codes(docs, path, tokenizer, end_id)
    return read_codes(docs.sparkSession, path)
