import pytest

from cartwake.llm import licenses as L
from cartwake.llm.decontaminate import words_of
from cartwake.llm.queries import QUERIES

from text_helpers import SMALL


def brute(text, templates, least=L.LEAST_DICE):
    """Every run of lines against every template."""
    sets = {n: s for n, t in templates if (s := set(zip(words_of(t), words_of(t)[1:])))}
    lines, best = [words_of(x) for x in (text or "").split("\n")], {}
    for a in range(len(lines)):
        w = []
        for b in range(a, len(lines)):
            w = w + lines[b]
            pairs = set(zip(w, w[1:]))
            for name, own in sets.items():
                dice = 2 * len(pairs & own) / (len(pairs) + len(own))
                if dice >= least and dice > best.get(name, (0,))[0]:
                    best[name] = dice, a, b
            if len(pairs) > 400:
                break
    return [(n, *v) for n, v in sorted(best.items())]


def test_query(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op2_licenses"](spark, SMALL).collect()}
    assert rows.keys() == texts.keys()
    assert any(r.n_licenses for r in rows.values())
    for d, text in texts.items():
        want = brute(text, L.TEMPLATES) if len(text) < 6000 else L.Templates(L.TEMPLATES).matches(text)
        assert rows[d].names == ",".join(n for n, *_ in want) and rows[d].n_licenses == len(want)
        assert rows[d].best_dice == (round(max(w[1] for w in want), 6) if want else None)


@pytest.mark.parametrize("name", [n for n, _ in L.TEMPLATES])
def test_changed_licence_among_prose(name):
    own = dict(L.TEMPLATES)[name]
    changed = own.replace("Software", "Library", 1).upper().replace(",", " ;")
    text = f"Some prose of the day\nmore of the same\n{changed}\n\nwith the rest of it\nAll rights reserved."
    found = L.Templates(L.TEMPLATES).matches(text)
    assert found == brute(text, L.TEMPLATES)
    assert name in [f[0] for f in found]


def test_notices_inside_lines():
    t = L.Templates(L.TEMPLATES)
    for text, want in [
        ("Copyright 2024 Foo Inc. All rights reserved.", [("all-rights-reserved", 1.0, 0, 0)]),
        ("Prose.\nReleased under the MIT License. Copyright Foo Inc.\nMore", [("mit-notice", 1.0, 1, 1)]),
        ("Copyright Foo Inc. All rights\nreserved. And more prose", [("all-rights-reserved", 1.0, 0, 1)]),
        ("the rights of all are reserved", []),
    ]:
        assert t.matches(text) == want
    # One long line; the notice that the header holds is part of it, one further on is not.
    header = dict(L.TEMPLATES)["apache-2.0-header"].replace("\n", " ")
    prose = " ".join(f"prose{i} of the license" for i in range(300))
    assert [m[0] for m in t.matches(f"{prose} {header} {prose}")] == ["apache-2.0-header"]
    again = dict(L.TEMPLATES)["apache-2.0-notice"]
    assert [m[:2] for m in t.matches(f"{prose} {header} {prose} {again} {prose}")] == [("apache-2.0-header", 1.0), ("apache-2.0-notice", 1.0)]
    bsd = dict(L.TEMPLATES)["bsd-3-clause"].replace("\n", " ")
    assert ("bsd-3-clause", 1.0, 0, 0) in t.matches(f"{prose} {bsd} {prose}")


def test_size_bounds():
    t = L.Templates([("a", "x y"), ("b", " ".join(f"w{i}" for i in range(101)))])
    assert [n for n, _ in t.in_bounds(1)] == ["a"] and [n for n, _ in t.in_bounds(150)] == ["b"]
    assert [n for n, _ in t.in_bounds(67)] == ["b"] and not t.in_bounds(66) and not t.in_bounds(151)


def test_odd_rows(odd, none):
    got = L.scan(odd)
    assert got.count() == odd.count() and got.columns.count("licenses") == 1
    assert L.scan(odd, templates=[]).where("size(licenses) > 0").count() == 0
    assert L.scan(odd, templates=[("one", "word"), ("no", "")]).where("size(licenses) > 0").count() == 0
    assert L.scan(none).count() == 0
