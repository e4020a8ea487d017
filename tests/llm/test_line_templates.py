import hashlib
import math
from collections import defaultdict

import pytest

from cartwake.llm import line_templates as L
from cartwake.llm.queries import QUERIES

from text_helpers import SMALL


def mask(line):
    return tuple("<*>" if any(c.isdigit() for c in t) else t for t in line.split())


def dropped(docs, min_docs, least=0.6, leading=3):
    """Masked lines of recurring templates, by one plain tree over all lines."""
    where, leaves = defaultdict(set), defaultdict(list)
    for d, text in docs:
        for line in text.split("\n"):
            if len(m := mask(line)) >= 3:
                where[m].add(d)
    for m in where:
        leaves[len(m), m[:leading]].append(m)
    gone = set()
    for lines in leaves.values():
        if len(set().union(*(where[m] for m in lines))) < min_docs:
            continue
        groups = []
        for m in sorted(lines, key=lambda m: (-len(where[m]), " ".join(m).encode())):
            shared = [sum(a == b != "<*>" for a, b in zip(t, m)) for t, _ in groups]
            if shared and max(shared) >= max(1, math.ceil(least * len(m) - 1e-9)):
                t, members = groups[shared.index(max(shared))]
                members.append(m)
                t[:] = [a if a == b else "<*>" for a, b in zip(t, m)]
            else:
                groups.append(([*m], [m]))
        for _, members in groups:
            if len(set().union(*(where[m] for m in members))) >= min_docs:
                gone |= set(members)
    return gone


def rest(text, gone):
    lines = text.split("\n")
    kept = [x for x in lines if mask(x) not in gone]
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def test_query(spark, texts):
    gone = dropped(texts.items(), L.MIN_DOCS)
    rows = QUERIES["op7_line_templates"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, lost, text = rest(texts[r.doc_id], gone)
        assert (r.n_lines, r.n_dropped, r.text_sha256) == (n, lost, hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("leaf_lines", [1000, 60])
def test_variable_fields(spark, leaf_lines):
    """Dates, names and numbers vary; a full leaf is split by its next tokens."""
    docs = []
    for i in range(120):
        name = "abcdefghij"[i % 10] * 3
        docs.append((i, f"Posted on 2024-0{i % 9}-01 by {name} in the general forum\nOwn line about {name} number {i * i} that stays q{i}\n"
                        f"only this document says {'xyz'[i % 3] * (i + 1)} here and {'uvw'[i % 3] * (i + 2)} there {i}q"))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.drop_recurring(df, min_docs=10, leaf_lines=leaf_lines).collect()}
    gone = dropped(docs, 10)
    assert any(m[:2] == ("Posted", "on") for m in gone)
    if leaf_lines == 1000:
        assert got == {d: rest(t, gone)[2] for d, t in docs}
    assert not any("Posted" in t for t in got.values())


def test_full_leaf_is_the_plain_tree(spark):
    """A varying field without digits in any place, among lines of the same leaf that fit nothing."""
    def word(*k):
        return "w" + "".join(chr(97 + int(c)) for c in "-".join(map(str, k)) if c != "-") + "abcd"[len(k) - 1]

    docs = []
    for i in range(240):
        rare = " ".join(word(i, k) for k in range(4)) if i % 3 else f"{word(i % 9, 1)} made {word(i % 5, 2)} by"
        docs.append((i, f"recommended for you {word(i)} by our editors today\nrecommended for you by our editors in {word(i)}\n"
                        f"recommended for you {rare} {word(i % 7)}\n{i} {i} {i} {word(i)} {'up' if i % 2 else 'down'} {word(i % 4)} end of row\n"
                        f"as seen on {word(i)}"))
    gone = dropped(docs, 10)
    want = {d: rest(t, gone)[2] for d, t in docs}
    assert not any("editors" in t or "as seen" in t for t in want.values()) and any("recommended" in t for t in want.values())
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for leaf_lines in (1000, 60, 5):
        assert {r.doc_id: r.text for r in L.drop_recurring(df, min_docs=10, leaf_lines=leaf_lines).collect()} == want


def test_long_passages_in_few_documents(spark):
    """Passages of 50 words in two to nine documents go, short lines need ten."""
    def passage(k, size):
        return " ".join("pqrstuvwxy"[k] * (j + 1) for j in range(size))

    docs = []
    for i in range(9):
        shared = [passage(k, size) for k in range(2, 10) for size in (49, 50) if i < k]
        docs.append((i, "\n".join([*shared, f"own words of {'abcdefghi'[i] * 4} only", passage(0, 60) if i == 0 else "x"])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text.split("\n") for r in L.drop_recurring(df, long_docs=2).collect()}
    for d, text in docs:
        assert got[d] == [x for x in text.split("\n") if len(x.split()) < 50 or len(x.split()) == 60]
    assert all(r.n_dropped == 0 for r in L.drop_recurring(df).collect())


def test_odd_rows(spark, odd, none):
    got = L.drop_recurring(odd, min_docs=2)
    assert sorted(got.columns) == sorted([*odd.columns, "n_dropped"])
    rows = got.collect()
    assert len(rows) == odd.count()
    # Equal rows are one document, so nothing recurs here.
    assert sorted(str(r.text) for r in rows) == sorted(str(r.text) for r in odd.select("text").collect())
    twice = spark.createDataFrame([(1, "a b c\nx", 1), (2, "a b c\ny", 1), (3, None, 1), (4, "", 1), (4, "", 1)], "doc_id long, text string, n_lines int")
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in L.drop_recurring(twice, min_docs=2).collect())
    assert got == [(1, "x", 2, 1), (2, "y", 2, 1), (3, None, 0, 0), (4, "", 1, 0), (4, "", 1, 0)]
    assert L.drop_recurring(none).count() == 0
