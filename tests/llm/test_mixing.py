import re
from collections import Counter, defaultdict
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from cartwake.llm import mixing as M
from cartwake.llm.queries import QUERIES

from text_helpers import SMALL


def best_sum(budget, counts):
    reach = {0}
    for s, n in counts:
        reach = {r + k * s for r in reach for k in range(n + 1) if r + k * s <= budget}
    return max(reach)


small = st.lists(st.tuples(st.integers(1, 30), st.integers(1, 4)), max_size=6, unique_by=lambda c: c[0])


@given(st.integers(0, 200), small)
@settings(max_examples=200, deadline=None)
def test_knapsack_is_optimal(budget, counts):
    got = M.knapsack(budget, counts)
    assert all(0 < n <= dict(counts)[s] for s, n in got.items())
    assert sum(s * n for s, n in got.items()) == best_sum(budget, counts)


@given(st.integers(0, 400), small)
@settings(max_examples=200, deadline=None)
def test_fill_is_optimal_where_the_reserve_holds_all(budget, counts):
    got = M.fill(budget, counts)
    assert all(0 <= n <= dict(counts)[s] for s, n in got.items())
    assert sum(s * n for s, n in got.items()) == best_sum(budget, counts)


def test_fill_is_exact_and_spread_on_many_documents():
    counts = [(s, 1 + 40_000 // s) for s in range(1, 2000)]
    total = sum(s * n for s, n in counts)
    got = M.fill(total // 3, counts)
    assert sum(s * n for s, n in got.items()) == total // 3
    share = [got[s] / n for s, n in counts if n > 100]
    assert min(share) > 0.3 and max(share) < 0.4


def test_targets():
    assert M.targets([100, 100, 100], [5, 2, 1]) == [Fraction(1500, 8), 75, Fraction(300, 8)]
    got = M.targets([10, 500, 490], [5, 2, 1])
    assert got[0] == 30 and sum(got) == 1000 and got[1] == 2 * got[2]
    assert M.targets([], []) == [] and M.targets([0, 0], [5, 2]) == [0, 0]
    assert M.targets([0, 9], [5, 2]) == [0, 9]


def test_query(spark, texts):
    rows = QUERIES["op8_mixing"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == texts.keys() and len(rows) == len(texts)
    source = defaultdict(int)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id]))
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
        source[r.source] += r["size"]
    names = sorted(source)
    want = dict(zip(names, M.targets([source[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))])))
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert r.source_size == source[r.source] and abs(r.target - want[r.source]) < 1e-6
    longest = max(r["size"] for r in rows)
    for n in names:
        assert -longest <= taken[n] - want[n] <= 1
    again = QUERIES["op8_mixing"](spark, SMALL).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_many_documents_of_one_length(spark, monkeypatch):
    """Parts of a length are ranked apart and still give the exact number."""
    monkeypatch.setattr(M, "RANKED", 16)
    docs = [(i, f"w{i} b c d e", f"s{min(i % 4, 1)}") for i in range(1000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = M.mix(df, weights=(1, 1)).collect()
    for s, target in (("s0", 2500), ("s1", 2500)):
        got = [r for r in rows if r.source == s]
        assert sum(r.taken for r in got) == target
        assert max(r.uses for r in got) - min(r.uses for r in got) <= 1


def test_odd_rows(odd, none):
    rows = M.mix(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.taken <= 3 * r["size"] for r in rows)
    assert all(r.uses == 0 for r in rows if not r["size"])
    order = {r.source for r in rows}
    assert None in order
    mixed = M.repeat(odd, M.mix(odd))
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r.uses for r in rows)
    assert M.mix(none).count() == 0 and M.repeat(none, M.mix(none)).count() == 0
