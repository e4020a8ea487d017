import hashlib
import re
import zlib
from collections import defaultdict

import oracle
import pytest
from pyspark.sql import functions as F
from text_helpers import SMALL

from cartwake.llm import prefix_trie as T
from cartwake.llm.queries import ORACLES, QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, family=20, most=4):
    """rows: (conv_id, turn, role, text).  A plain trie over tuples of turns."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        head = c - (abs(c) % family) * (1 if c >= 0 else -1)
        whole = tuple(own.get(head, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    kids = defaultdict(list)
    for n in members:
        if n:
            kids[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        leaves[n] = sum(leaves[k] for k in kids[n]) if kids[n] else 1
        saved[n] = (len(members[n]) - 1) * words + sum(saved[k] for k in kids[n])
    return sorted(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else -1, len(members[n]), len(kids[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest(),
        )
        for n in members
    )


def rows_of(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*COLUMNS).collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_query_against_sql(spark):
    assert oracle.compare(QUERIES["op11_prefix_trie"](spark, SMALL), oracle.connect(SMALL), ORACLES["op11_prefix_trie"]) is None


def test_query_against_brute_force(spark):
    got = QUERIES["op11_prefix_trie"](spark, SMALL)
    convs = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    assert rows_of(got) == brute([(r.conv_id, r.turn, r.role, r.text) for r in convs])


@pytest.fixture(scope="module")
def odd_turns():
    """Nulls, repeats, ties, lost turns, negative ids, a hot conversation and a deep one."""
    rows = [(None, 1, "user", "no conversation"), (None, None, None, None)]
    for c in [*range(-45, 90, 3), 2**62]:
        rows += [(c, t, "user" if t % 2 else "assistant", f"turn {t} of {c % 4}") for t in range(c % 7)]
    rows += [(c, t, "user", "same  words here\x0b") for c in range(200, 1200) for t in range(3)]
    rows += [(7, None, None, None), (7, None, None, None), (9, 1, "b", "x"), (9, 1, "a", "x"), (9, 1, "a", None), (9, 1, None, "")]
    rows += [(5001, 0, "user", "only one")]
    rows += [(6000, t, "user", f"deep {t}") for t in range(40)]
    return rows


@pytest.mark.parametrize("band", [3, 16])
def test_odd_turns(spark, odd_turns, band):
    got = T.shared_head_trie(table(spark, odd_turns), band=band)
    assert rows_of(got) == brute(odd_turns)


def test_a_round_makes_at_most_a_band_of_rows(spark, odd_turns):
    members = T.prefixes(T.with_shared_heads(T.turns_of(table(spark, odd_turns))), band=4)
    longest = members.select(F.size(T._ancestors(4)).alias("n"), "depth").distinct().collect()
    assert {(r.depth, r.n) for r in longest} == {(d, (d - 1) % 4 + 1 if d else 0) for d in range(41)}


def test_pieces_of_a_node_read_in_order(spark):
    ids = spark.range(3000).selectExpr("0L as depth", "0L as k1", "0L as k2", "id as conv_id")
    got = T.end_digests(ids.repartition(7), chunk=13).collect()
    assert [r.ends_sha256 for r in got] == [hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()]


def test_no_conversations_and_other_columns(spark):
    none = table(spark, [])
    assert T.shared_head_trie(none).count() == 0
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b c"), (20, 0, "user", "z")]
    more = table(spark, rows).withColumns({n: F.lit("own") for n in ("depth", "k1", "k2", "words", "place", "part", "last", "Conv", "a.b")})
    assert rows_of(T.shared_head_trie(more)) == brute(rows)
    nothing = table(spark, [(None, 1, "user", "a")])
    assert T.shared_head_trie(nothing).count() == 0
