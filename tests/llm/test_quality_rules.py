import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import oracle
from cartwake.llm import quality_rules as R
from cartwake.llm.queries import ORACLES, QUERIES

from text_helpers import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = list(zip(w, w[1:], w[2:]))
    n, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_query_equals_its_sql(spark):
    con = oracle.connect(SMALL)
    assert oracle.compare(QUERIES["op5_quality_rules"](spark, SMALL), con, ORACLES["op5_quality_rules"]) is None


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op5_quality_rules"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_odd_rows(spark, odd, none):
    long = "a b c " * 5000 + "# $ & *\n" + "x y\n" * 3 + " \n\n" + "d e f g " * 2
    docs = odd.select("doc_id", "text", "n_words").unionByName(
        spark.createDataFrame([(50, long, "own"), (51, "p q r p q r", "own"), (52, "p p p p", "own")], "doc_id long, text string, n_words string")
    )
    rows = R.with_statistics(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert tuple(r[c] for c in R.BASE) == brute(r.text)
    assert R.cascade(none).count() == 0
    assert R.cascade(odd).columns.count("rejected_by") == 1


@pytest.mark.parametrize("bits", [2, 62])
def test_shortened_keys_fall_back(spark, monkeypatch, bits):
    """Keys that mix windows, and texts with more windows than places, take the other way."""
    monkeypatch.setattr(R, "PLACE_BITS", bits)
    texts = ["a b c d a b c e b c d", "q " * 9, "one two three", "a b c x a b c y d e f z d e f"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_repeat_words for r in R.with_statistics(df).collect()} == {i: brute(t)[4] for i, t in enumerate(texts)}


def test_order_never_changes_what_is_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    stats = R.with_statistics(docs)
    rules = R.default_rules()
    order = R.order_rules(stats.limit(100).cache(), rules)
    assert {r.name for r, _, _ in order} == {r.name for r in rules}
    assert [s / c for _, c, s in order] == sorted((s / c for _, c, s in order), reverse=True)
    kept = {r.doc_id for r in R.cascade(docs, rules[::-1]).where("rejected_by is null").collect()}
    every = stats
    for rule in rules:
        every = every.where(~F.coalesce(rule.rejects, F.lit(False)))
    assert kept == {r.doc_id for r in every.collect()}
