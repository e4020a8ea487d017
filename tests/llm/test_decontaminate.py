import hashlib
import re

from cartwake.llm import decontaminate as D
from cartwake.llm.queries import QUERIES

from text_helpers import SMALL

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def windows(items, size=13):
    out = {}
    for i, text in items:
        w = words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1) if w else ():
            out.setdefault(tuple(w[k : k + n]), set()).add(i)
    return out


def brute(text, found):
    w, hit, items = words(text), set(), set()
    for n in {len(k) for k in found}:
        for k in range(len(w) - n + 1):
            if (ids := found.get(tuple(w[k : k + n]))) is not None:
                hit.update(range(k, k + n))
                items |= ids
    return len(w), len(hit), sorted(items)


def test_query(spark, texts):
    bench = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = windows(bench)
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_decontaminate"](spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    for d, text in texts.items():
        n, hit, items = brute(text, found)
        sha = hashlib.sha256(",".join(items).encode()).hexdigest()
        assert got[d] == (n, hit, len(items), sha, hit > 0 and 20 * hit >= n), d


def test_odd_rows_blocks_and_offsets(spark, odd):
    items = [(1, "SOME-words"), (2, None), (None, "café"), (3, "..."), (3, "beta gamma"), (4, " ".join(f"w{i}" for i in range(100, 130)))]
    table = spark.createDataFrame(items, "item_id long, text string")
    one = D.scan(odd, table)
    assert "lang" in one.columns and one.columns.count("n_words") == 1
    rows = one.collect()
    found = windows([("" if i is None else str(i), t) for i, t in items])
    for r in rows:
        n, hit, ids = brute(r.text, found)
        assert (r.n_words, r.n_hit, sorted(r.hit_items)) == (n, hit, ids)
        covered = [w for s in r.hit_spans for w in words(r.text[s.start : s.stop])]
        assert len(covered) == hit
    # Several blocks of items give the same as one.
    many = D.scan(odd, table, block_bytes=12)
    assert sorted(map(str, many.collect())) == sorted(map(str, rows))


def test_empty_tables(spark, odd, none):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.scan(none, items).count() == 0
    assert D.scan(odd, items.limit(0)).where("n_hit > 0 or contaminated").count() == 0


def test_threshold(spark):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    docs = [(1, "one two " + "x " * 38), (2, "one two " + "x " * 39)]
    got = {r.doc_id: r.contaminated for r in D.scan(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {1: True, 2: False}
