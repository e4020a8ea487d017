"""Names that clash, repeated rows in a bounded sample, blocks and pieces of items."""

import random

import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute, windows

from cartwake.llm import decontaminate as D
from cartwake.llm import licenses, line_templates, mixing, quality, simhash_dedup

NAMES = ["_row", "_uses", "_copy", "_places", "a.b", "Score", "FP", "Licenses", "N_Words", "k0", "n0"]


@pytest.fixture(scope="module")
def clash(spark):
    rows = [(i, f"line one of all\nwords w{i} w{i + 1} apart", "s", "own") for i in range(12)] + [(0, "line one of all\nwords w0 w1 apart", "s", "own")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, mine string")
    return df.select("doc_id", "text", "source", *[F.col("mine").alias(n) for n in NAMES])


def kept(df, names):
    assert set(names) <= set(df.columns)
    for r in df.select(*[F.col(f"`{n}`").alias(f"x{i}") for i, n in enumerate(names)]).collect():
        assert all(v == "own" for v in r)


def without(*gone):
    return [n for n in NAMES if n not in gone]


def test_other_columns_come_through(spark, clash):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    scored = quality.score(clash, quality.train(clash, labels))
    kept(scored, without("Score"))
    assert scored.columns.count("score") == 1 and "Score" not in scored.columns and scored.count() == 13
    items = spark.createDataFrame([(1, "one of all")], "item_id long, text string")
    found = D.scan(clash, items)
    kept(found, without("N_Words"))
    assert {r.n_hit for r in found.select("n_hit").collect()} == {3}
    scanned = licenses.scan(clash)
    kept(scanned, without("Licenses"))
    marked = simhash_dedup.with_fingerprints(clash)
    kept(marked, without("FP"))
    first = simhash_dedup.keep_first(clash)
    kept(first, NAMES)
    assert first.columns == clash.columns
    mixed = mixing.repeat(clash, mixing.mix(clash))
    kept(mixed, NAMES)
    assert mixed.columns == clash.columns and mixed.count() == 13
    dropped = line_templates.drop_recurring(clash)
    kept(dropped, NAMES)
    assert dropped.count() == 13


def test_sample_is_bounded_under_repeats(spark, monkeypatch):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    hot = spark.range(30000).select(F.lit(0).cast("long").alias("doc_id"), F.lit("text 0").alias("text"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    seen = []
    plain = quality.fit_buckets
    monkeypatch.setattr(quality, "fit_buckets", lambda rows, good, ratio: seen.append(list(good)) or plain(rows, good, ratio))
    quality.train(docs.unionByName(hot), labels, fit_rows=50)
    assert (seen[0].count(True), seen[0].count(False)) == (50, 50)
    quality.train(docs, labels, fit_rows=1000)
    free = docs.where(~quality.held_out(F.col("doc_id"))).count()
    assert len(seen[1]) == free


@pytest.mark.parametrize("block_bytes", [200, 1 << 20])
def test_long_items_in_pieces(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(D, "PIECE", 8)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(6)]
    items = [(str(i), " ".join(rng.choices(words, k=n))) for i, n in enumerate([1, 4, 5, 12, 13, 40, 90])]
    docs = [(i, " ".join(rng.choices(words, k=60))) for i in range(30)] + [(99, items[6][1].upper()), (98, "w0-" + items[5][1])]
    got = D.scan(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"),
        window=5, block_bytes=block_bytes).collect()
    found = windows(items, 5)
    texts = dict(docs)
    for r in got:
        assert (r.n_words, r.n_hit, sorted(r.hit_items)) == brute(texts[r.doc_id], found)


def test_many_windows_stay_small(spark):
    """A hundred thousand windows of different words make one automaton of a node per word."""
    rng = random.Random(1)
    items = [(str(i), " ".join(f"x{rng.randrange(10**9)}" for _ in range(100))) for i in range(1150)]
    w = D.Windows(items)
    stats = w.machine.get_stats()
    assert stats["words_count"] > 100_000 and stats["total_size"] < 200 << 20
    runs, ids = w.hits(D.words_of("pad " + items[7][1] + " pad"))
    assert runs == [(1, 101)] and ids == {"7"}
