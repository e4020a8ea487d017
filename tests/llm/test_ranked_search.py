import math
import re
from collections import Counter

import oracle
import pytest
from pyspark.sql import functions as F
from text_helpers import SMALL

from cartwake.llm import ranked_search as R
from cartwake.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=50):
    """docs: (doc_id, text); items: (item_id, text), in order.  Every document for every item."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for (d, c), size in zip(counted, sizes):
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 20 * (50 + 50 * size * n // total)))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return out


def key(r):
    return str(r[0]), r[1], str(r[2]), r[3]


def search(docs, items, **options):
    return sorted(map(tuple, R.search(R.build_index(docs), items, **options).collect()), key=key)


def pairs(df, a, b="text"):
    return [(r[a], r[b]) for r in df.select(a, b).collect()]


def test_query(spark):
    assert oracle.compare(QUERIES["op12_ranked_search"](spark, SMALL), oracle.connect(SMALL), ORACLES["op12_ranked_search"]) is None


@pytest.mark.parametrize("docs_a_block,k", [(7, 3), (50, 50), (16_384, 5)])
def test_blocks_bundles_and_k(spark, monkeypatch, docs_a_block, k):
    monkeypatch.setattr(R, "BLOCK_DOCS", docs_a_block)
    monkeypatch.setattr(R, "BUNDLE_BITS", 2)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = search(docs.repartition(3), items, k=k)
    assert got == sorted(brute(pairs(docs, "doc_id"), pairs(items, "item_id"), k), key=key)


def test_pruning_keeps_what_may_win():
    import numpy as np

    score = np.array([9, 1, 5, 5, 0])
    assert R._may_win(score, 0, 2).tolist() == [0, 2, 3]
    assert R._may_win(score, 4, 2).tolist() == [0, 1, 2, 3]
    assert R._may_win(score, 0, 5).tolist() == [0, 1, 2, 3, 4]


def test_odd_rows(spark, odd):
    hot = spark.createDataFrame([(100 + i // 2, "alpha words of a copy") for i in range(400)], "doc_id long, text string")
    docs = odd.unionByName(hot, allowMissingColumns=True).withColumnsRenamed({"row": "a.b", "size": "Term", "start": "block"})
    items = spark.createDataFrame(
        [(1, "ALPHA beta été"), (1, "ALPHA beta été"), (2, None), (3, ""), (None, "words w1 w7000"), (4, "nowhere found"), (5, "of of a 1 000 50 …"), (6, "x y 😀")],
        "item_id long, text string",
    ).withColumns({n: F.lit("own") for n in ("item", "terms", "score", "a.b")})
    got = search(docs, items)
    assert got == sorted(brute(pairs(docs, "doc_id"), pairs(items, "item_id")), key=key)


def test_empty_tables(spark, odd, none):
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert search(none, items) == []
    assert search(odd, items.limit(0)) == []
    assert search(odd.where("text is null"), items) == []
