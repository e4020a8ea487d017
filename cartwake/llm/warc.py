"""WARC archives of pages: written with revisits, segments and chunked bodies, read back whole.

Spark's text writer puts the records into gzip files, so failed tasks leave nothing and any
store it knows will do; the files are plain WARC/1.1 inside.  A reader takes a file apart record
by record.  Segments meet by the identifier of their origin, in order of their numbers;
their total length is verified before the chunked body is decoded.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwake.llm.common import slices, text_of
from cartwake.sources.files import shared_folder, stored

#: Payloads of fewer bytes are never revisited.
LEAST_SHARED = 100
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
#: Records in a file, which bounds what one row of file content can hold.
FILE_RECORDS = 10_000
DATE = "2024-01-01T00:00:00Z"

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- records ----------------------------------------------------------------
def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A payload in chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunk(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk has no size")
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16)
        except ValueError:
            raise ValueError("a chunk size is no number") from None
        at = end + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP message block, decoded if it is chunked."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        raise ValueError("a block has no end of its head")
    fields = dict(_field(x) for x in head.decode("latin-1").split("\r\n")[1:])
    return dechunk(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body


def _field(line: str) -> tuple[str, str]:
    name, _, value = line.partition(":")
    return name.strip().lower(), value.strip()


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record; fields without a value are left out."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _line(value: str | None) -> str | None:
    # A field ends with its line.
    return None if value is None else value.replace("\r", "%0D").replace("\n", "%0A").strip()


def records_of(page_id, url, payload: bytes, digest: str, refers_to, name: str, segment: int) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response with its continuations."""
    own = f"<urn:page:{name}>"
    about = [("WARC-Date", DATE), ("WARC-Target-URI", _line(url)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-Id", page_id)]
    kind = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), *about, ("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", refers_to), kind]
        yield record(fields, HTTP_HEAD + b"\r\n")
        return
    block = HTTP_HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    first = ("WARC-Segment-Number", 1 if len(parts) > 1 else None)
    yield record([("WARC-Type", "response"), ("WARC-Record-ID", own), *about, first, kind], parts[0])
    for n, part in enumerate(parts[1:], 2):
        total = ("WARC-Segment-Total-Length", len(block) if n == len(parts) else None)
        yield record(
            [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{name}:{n}>"), ("WARC-Date", DATE),
             ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", n), total],
            part,
        )


def read_records(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of each record of a binary stream."""
    while line := file.readline():
        if line.strip() == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a record does not begin with its version")
        fields = {}
        while (line := file.readline()) not in (b"\r\n", b"\n", b""):
            k, v = _field(line.decode("utf-8", "replace").rstrip("\r\n"))
            fields[k] = v
        size = int(fields["content-length"])
        block = file.read(size)
        if len(block) != size:
            raise ValueError("a record is cut short")
        yield fields, block


# -- write ------------------------------------------------------------------
def with_first(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``digest`` and ``refers_to`` of each page."""
    body = text_of(html)
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("html"),
        F.sha2(body, 256).alias("digest"),
    )
    shared = (
        rows.where(F.octet_length("html") >= LEAST_SHARED).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(other, F.col("first")).alias("refers_to")
    )


def write(pages: DataFrame, path: str, page_id: str = "page_id", html: str = "html", segment: int = SEGMENT_BYTES) -> None:
    """A response or revisit for each page, in gzip files below ``path``.

    Of pages with equal payloads of at least ``LEAST_SHARED`` bytes, those with the least id
    are responses and the others revisit them; if none has an id, all are responses.
    Null html is an empty payload, a page without a url has no target.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "html"):
            out = []
            for row in batch.to_pylist():
                name = f"{row['digest'][:16]}:{part}-{k}"
                k += 1
                payload = row["html"].encode("utf-8")
                # The writer ends each row with the last line feed of its record.
                out += [r[:-1] for r in records_of(row["page_id"], row["url"], payload, row["digest"], row["refers_to"], name, segment)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = with_first(pages, page_id, html).mapInArrow(build, "record binary")
    records.select(F.col("record").cast("string")).write.option("compression", "gzip").option(
        "lineSep", "\n"
    ).option("maxRecordsPerFile", FILE_RECORDS).text(path)


# -- read -------------------------------------------------------------------
PARSED = (
    "origin string, kind string, number int, total long, page_id long, url string, digest string, "
    "refers_to long, payload_bytes long, payload_digest string, block binary, error string"
)


def _number(fields: dict[str, str], name: str) -> int | None:
    return int(fields[name]) if name in fields else None


def _checked(block: bytes, digest: str | None) -> tuple[int | None, str | None, str | None]:
    """(bytes, digest, error) of the payload of a whole block."""
    try:
        payload = payload_of(block)
    except ValueError as e:
        return None, None, str(e)
    own = hashlib.sha256(payload).hexdigest()
    return len(payload), own, None if digest in (None, own) else "the payload digest differs"


def parse(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; the blocks of segments are kept, others are decoded."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PARSED.split(", ")]
        kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in PARSED.split(", ")])
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_buffer()
                stream = pa.BufferReader(data)
                file = io.BufferedReader(gzip.GzipFile(fileobj=stream) if data.slice(0, 2).to_pybytes() == b"\x1f\x8b" else stream)
                rows, held = [], 0
                for fields, block in read_records(file):
                    kind = fields.get("warc-type")
                    number = _number(fields, "warc-segment-number")
                    digest = (fields.get("warc-payload-digest") or "").removeprefix("sha256:") or None
                    row = dict.fromkeys(names) | {
                        "origin": fields.get("warc-segment-origin-id") or fields.get("warc-record-id"),
                        "kind": kind, "number": number, "total": _number(fields, "warc-segment-total-length"),
                        "page_id": _number(fields, "x-page-id"), "url": fields.get("warc-target-uri"), "digest": digest,
                        "refers_to": _number(fields, "x-refers-to-page-id"),
                    }
                    if number is not None:
                        row["block"] = block
                        held += len(block)
                    elif kind == "response":
                        row["payload_bytes"], row["payload_digest"], row["error"] = _checked(block, digest)
                    rows.append(row)
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(work, PARSED)


def reassemble(segments: DataFrame) -> DataFrame:
    """Whole responses of segment rows; a group is the segments of one record.

    ``error`` says what is amiss: a missing or repeated segment, a total that differs, a
    body that cannot be decoded, or another digest.
    """
    grouped = segments.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
        *[F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("page_id", "url", "digest")],
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, errors = [], [], []
            for parts, total, digest in zip(*(batch.column(c) for c in ("parts", "total", "digest"))):
                parts = parts.as_py()
                numbers = [p["number"] for p in parts]
                block = b"".join(p["block"] for p in parts)
                found = None, None, None
                if numbers != list(range(1, len(parts) + 1)):
                    found = None, None, "a segment is missing or repeated"
                elif total.as_py() != len(block):
                    found = None, None, "the total length differs"
                else:
                    found = _checked(block, digest.as_py())
                sizes.append(found[0])
                digests.append(found[1])
                errors.append(found[2])
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(errors, pa.string())],
                ["page_id", "url", "payload_bytes", "payload_digest", "error"],
            )

    return grouped.mapInArrow(work, "page_id long, url string, payload_bytes long, payload_digest string, error string")


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of the archives at ``path``: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, error.

    The payload of a revisit is that of the response it refers to; ``error`` says if there
    is none.  An archive without records gives no rows.
    """
    parsed = stored(parse(spark, path), "warc-records")
    out = ["page_id", "url", "payload_bytes", "payload_digest", "error"]
    whole = parsed.where("kind = 'response' and number is null").select(*out)
    responses = whole.unionByName(reassemble(parsed.where("number is not null")))
    known = responses.where("error is null and page_id is not null").groupBy(
        F.col("payload_digest").alias("digest"), F.col("page_id").alias("refers_to")
    ).agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = parsed.where("kind = 'revisit'").select("page_id", "url", "digest", "refers_to").join(
        known, ["digest", "refers_to"], "left"
    ).select(
        "page_id", "url", "payload_bytes", F.col("digest").alias("payload_digest"),
        F.when(F.col("payload_bytes").isNull(), "no response to revisit").alias("error"), "refers_to",
    )
    plain = responses.select(*out, F.lit(None).cast("long").alias("refers_to"))
    return plain.withColumn("record_type", F.lit("response")).unionByName(
        revisits.withColumn("record_type", F.lit("revisit"))
    )


def archive(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read those back."""
    path = shared_folder(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path)
