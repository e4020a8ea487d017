import gzip
import hashlib
import io

import pytest
from hypothesis import given
from hypothesis import strategies as st

import oracle
from cartwake.llm import warc as W
from cartwake.llm.queries import ORACLES, QUERIES

from text_helpers import SMALL


@given(st.binary(max_size=500), st.integers(1, 64))
def test_chunks_round_trip(payload, size):
    assert W.dechunk(W.chunked(payload, size)) == payload
    assert W.payload_of(W.HTTP_HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + W.chunked(payload, size)) == payload


@pytest.mark.parametrize("body", [b"", b"5\r\nab", b"z\r\n", b"2\r\nabc\r\n0\r\n\r\n", b"-1\r\n\r\n", b"2\r\nab\r\n"])
def test_bad_chunks_are_refused(body):
    with pytest.raises(ValueError):
        W.dechunk(body)


def test_chunk_extensions_and_trailers():
    assert W.dechunk(b"3;x=1\r\nabc\r\n0\r\nT: 1\r\n\r\n") == b"abc"


def test_query_equals_its_sql(spark):
    con = oracle.connect(SMALL)
    assert oracle.compare(QUERIES["op10_warc"](spark, SMALL), con, ORACLES["op10_warc"]) is None


def test_segments_and_odd_rows(spark, tmp_path):
    long, twice = "ü" * 9000 + "\r\n\r\nWARC/1.1\r\n", "same text " * 20
    rows = [
        (1, "http://a/\nx", long), (2, None, twice), (3, "u", twice), (None, "u", twice), (3, "u", twice), (4, "u", None), (5, "u", ""),
        (6, "u", "short"), (7, "u", "short"), (8, "u", "x" * 100), (9, "u", "x" * 100), (10, "u", "y" * 99), (11, "u", "y" * 99),
        (None, "u", "z" * 200), (None, "u", "z" * 200),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as first", "3 as refers_to")
    W.write(pages, str(tmp_path / "w"), segment=700)
    got = W.read(spark, str(tmp_path / "w")).collect()
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        refers = first.get(h) if first.get(h) != i else None
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if refers is not None else "response", refers, None))
    assert sorted(map(str, [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.error) for r in got])) == sorted(map(str, want))
    # The files are WARC that any reader of the format can take apart.
    kinds = []
    for f in (tmp_path / "w").rglob("part-*.gz"):
        for fields, _ in W.read_records(io.BufferedReader(gzip.open(f))):
            kinds.append(fields["warc-type"])
    assert kinds.count("continuation") > 10 and kinds.count("revisit") == 4


def test_faults_of_segments_are_told(spark, tmp_path):
    block = W.HTTP_HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + W.chunked(b"p" * 300)
    digest = "sha256:" + hashlib.sha256(b"p" * 300).hexdigest()

    def record(kind, origin, number, part, total=None, digest=digest):
        own = f"<{origin}>" if number == 1 else f"<{origin}:{number}>"
        fields = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", total)]
        fields += [("X-Page-Id", origin), ("WARC-Payload-Digest", digest)] if number == 1 else [("WARC-Segment-Origin-ID", f"<{origin}>")]
        return W.record(fields, part)

    parts = [block[:200], block[200:300], block[300:]]
    out = {
        "1": [(3, parts[2], len(block)), (1, parts[0], None), (2, parts[1], None)],  # out of order, whole
        "2": [(1, parts[0], None), (3, parts[2], len(block))],  # one missing
        "3": [(1, parts[0], None), (2, parts[1], None), (3, parts[2], len(block) + 1)],  # other length
        "4": [(2, block[200:] + b"x", len(block) + 1), (1, block[:200], None)],  # other bytes after the end
    }
    (tmp_path / "w").mkdir()
    for i, key in enumerate(out):
        data = b"".join(record("response" if n == 1 else "continuation", key, n, p, t) for n, p, t in out[key])
        data += record("response", f"9{key}", 1, block, len(block), "sha256:" + "0" * 64) if key == "1" else b""
        (tmp_path / "w" / f"f{i}.warc").write_bytes(data)
    got = {r.page_id: (r.payload_bytes, r.error) for r in W.read(spark, str(tmp_path / "w")).collect()}
    assert got[1] == (300, None) and got[4] == (300, None)
    assert got[2] == (None, "a segment is missing or repeated")
    assert got[3] == (None, "the total length differs")
    assert got[91] == (300, "the payload digest differs")


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.archive(pages).count() == 0
