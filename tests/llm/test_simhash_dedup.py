import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from cartwake.llm import simhash_dedup as S
from cartwake.llm.components import stars
from cartwake.llm.queries import QUERIES

from text_helpers import SMALL


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    """Of (id, fp): least id of each row's component, by all pairs."""
    kinds = sorted(set(f for _, f in fps))
    parent = {f: f for f in kinds}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    arr = np.array(kinds, dtype=np.uint64)
    for i, f in enumerate(kinds):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= 4):
            parent[find(kinds[i + 1 + j])] = find(f)
    least = {}
    for d, f in fps:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [least.get(find(f)) for _, f in fps]


def test_query(spark, texts):
    fps = [(d, fingerprint(t)) for d, t in sorted(texts.items())]
    want = [(d, f"{f:016x}", c) for (d, f), c in zip(fps, components(fps))]
    assert sorted(map(tuple, QUERIES["op6_simhash_dedup"](spark, SMALL).collect())) == want


def test_fingerprint_of_odd_texts(odd):
    for r in odd.select("text").collect():
        if len(r.text or "") < 1000:
            assert S.fingerprint(r.text) == fingerprint(r.text)


def close_fps(n, seed=0):
    rng, out = random.Random(seed), []
    for _ in range(n):
        if out and rng.random() < 0.6:
            f = rng.choice(out)
            for b in rng.sample(range(64), rng.randint(1, 6)):
                f ^= 1 << b
        else:
            f = rng.getrandbits(64)
        out.append(f)
    return sorted(set(out))


def linked(spark, fps, most):
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r.u: r.v for r in stars(S.links(df, most)).collect()}
    groups = {}
    for f, s in zip(fps, signed):
        groups.setdefault(roots.get(s, s), set()).add(f)
    return sorted(map(sorted, groups.values()))


def test_links_equal_all_pairs_with_and_without_long_lists(spark):
    fps = close_fps(400)
    want = {}
    for f, c in zip(fps, components([(i, f) for i, f in enumerate(fps)])):
        want.setdefault(c, set()).add(f)
    want = sorted(map(sorted, want.values()))
    assert linked(spark, fps, S.LIST_MOST) == want
    assert linked(spark, fps, 2) == want  # midpoints nearly everywhere


def test_lists_across_batches():
    """A list that ends in a later batch is one list."""
    fps = np.arange(7, dtype=np.uint64)
    choice, key = np.zeros(7, np.int32), np.zeros(7, np.int64)
    batches = [
        pa.RecordBatch.from_arrays([pa.array(choice[a:b]), pa.array(key[a:b]), pa.array(fps[a:b].view(np.int64))], ["choice", "bytes", "fp"])
        for a, b in ((0, 1), (1, 3), (3, 7))
    ]
    got = {(int(u), int(v)) for _, us, vs in S._walk(iter(batches), 100) for u, v in zip(us, vs)}
    assert {u for u, _ in got} == {1, 2, 3, 4, 5, 6} and {v for _, v in got} == {0}


def test_near_duplicates_of_odd_rows(odd):
    rows = S.near_duplicates(odd).collect()
    fps = [(r.doc_id, r.fp & (2**64 - 1)) for r in rows]
    assert [r.component_id for r in rows] == components(fps)
    assert len(rows) == odd.count()


def test_one_row_of_each_group_stays(spark, odd):
    kept = S.keep_first(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    groups = {r.component_id for r in S.near_duplicates(odd).collect()}
    assert set(ids) == groups and len(ids) >= len(groups)
    none = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, "c d e f g h")], "doc_id long, text string")
    assert S.keep_first(none).count() == 2


def test_empty_table(none):
    assert S.near_duplicates(none).count() == 0
    assert S.keep_first(none).count() == 0


def test_stars_of_a_chain(spark):
    n = 200
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame(list(zip(ids, ids[1:])), "u long, v long")
    assert {(r.u, r.v) for r in stars(df).collect()} == {(i, 0) for i in range(1, n)}
