import html as H
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cartwake.llm import page_text as P
from cartwake.llm.queries import QUERIES

from text_helpers import SMALL


def article(html):
    """The article of the test pages, whose inline tags are only <b>."""
    inner = re.search("<article>(.*)</article>", html, re.S)[1].replace("<b>", "").replace("</b>", "")
    blocks = (" ".join(H.unescape(t).split()) for t in re.split("<[^>]*>", inner))
    return "\n".join(b for b in blocks if b)


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = QUERIES["op9_page_text"](spark, SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        want = article(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


def test_blocks():
    lines = P.lines_of(
        "<title>t</title><p>foo <b>bar</b>\n baz <span class='share x'>cut<i>this</i></span> q<br>z</p>"
        "<div class=ad>AD<p>more</div><ul><li>a<li>b</ul><!-- <p>no --><script>'<p>no</p>'</script>"
        "<article><header class=post-header><h1>T</h1></header><p>x &amp; y&nbsp;&lt;b&gt; &am z"
        "<section id='comments'><p>c</section><p hidden>h<p>end</article><footer>f</footer>"
    )
    assert lines == [
        ("foo bar baz q z", 1), ("AD", 0), ("more", 0), ("a", 1), ("b", 1), ("T", 2), ("x & y <b> &am z", 2),
        ("c", 0), ("h", 0), ("end", 2), ("f", 0),
    ]
    assert P.main_text(lines) == "T\nx & y <b> &am z\nend"


@given(st.text(alphabet=st.sampled_from("<>/ap divb\"'=!-& \n"), max_size=80))
@settings(max_examples=300, deadline=None)
def test_broken_markup_never_fails(text):
    assert "\n" not in "".join(t for t, _ in P.lines_of(text))
    P.main_text(P.lines_of(text, with_out=False))


def length(a, b):
    rows = [[0] * (len(b) + 1)]
    for x in a:
        last, row = rows[-1], [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[j], last[j + 1]))
        rows.append(row)
    return rows[-1][-1]


def test_common_subsequence_is_longest():
    rng = random.Random(2)
    for n in (0, 1, 5, 40, 260):
        for _ in range(8):
            a = [rng.randrange(max(1, n // 3)) for _ in range(n)]
            b = [rng.randrange(max(1, n // 3)) for _ in range(rng.randint(0, n + 9))] if n else []
            got = P.common(a, b)
            assert len(got) == length(a, b)
            assert all(a[i] == b[j] for i, j in got)
            assert all(p < q and r < s for (p, r), (q, s) in zip(got, got[1:]))


def neighbours_brute(pages):
    """Texts by comparing every page with the next in order, in one list."""
    lines = {i: P.lines_of(h) for i, (_, _, h) in enumerate(pages)}
    order = sorted(range(len(pages)), key=lambda i: (pages[i][1].split("/")[2], pages[i][1].split("/", 3)[3]))
    gone = {i: set() for i in lines}
    for i, j in zip(order, order[1:]):
        if pages[i][1].split("/")[2] == pages[j][1].split("/")[2]:
            for x, y in P.common([t for t, _ in lines[i]], [t for t, _ in lines[j]]):
                gone[i].add(x)
                gone[j].add(y)
    out = {}
    for i, ls in lines.items():
        main = [t for t, k in ls if k == P.MAIN]
        out[pages[i][0]] = "\n".join(main or [t for n, (t, k) in enumerate(ls) if k and n not in gone[i]])
    return out


def test_shared_lines_of_neighbours_go(spark):
    """Over many tasks and one hot host, as if the pages stood in one list."""
    rng = random.Random(3)
    menus = [[f"menu {m} {k}" for k in range(4)] for m in range(3)]
    pages = []
    for i in range(400):
        host = "hot" if i % 3 else f"h{i % 7}"
        menu = "".join(f"<div>{x}</div>" for x in menus[i // 60 % 3])
        body = f"<div>own {i}</div>" if rng.random() < 0.8 else f"<article><p>{menus[0][0]}<p>own {i}</article>"
        pages.append((i, f"http://{host}/p/{i:04d}", f"<div class=ad>ad</div>{menu}{body}<div>end</div>"))
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(8)
    got = {r.page_id: r.text for r in P.extract(df).collect()}
    assert got == neighbours_brute(pages)
    assert sum(t.startswith("own") for t in got.values()) > 300


def test_copies_keep_their_text(spark):
    """Mirrors, print views and repeated rows next to each other, without an article element."""
    menu = "".join(f"<div>menu {k}</div>" for k in range(4))
    pages, want = [], {}
    for i in range(60):
        own = [f"paragraph {k} of page {i} with {'many ' * 9}words" for k in range(6)]
        body = "".join(f"<p>{x}</p>" for x in own)
        views = [(f"/p/{i:03d}{x}", body, own) for x in ("", "?print=1", "/mirror")[: i % 4]] or [(f"/p/{i:03d}", body, own)]
        if i % 3 == 0:
            views += [(f"/p/{i:03d}/view{v}", body + f"<p>view {v}</p>", [*own, f"view {v}"]) for v in range(3)]
        for url, html, text in views * (2 if i % 5 == 0 else 1):
            pages.append((len(pages), f"http://h/{url}", menu + html + "<div>end</div>"))
            want[len(pages) - 1] = "\n".join(text)
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for parts in (1, 8):
        assert {r.page_id: r.text for r in P.extract(df.repartition(parts)).collect()} == want
    # Copies alone on their host have nothing to compare with.
    alone = spark.createDataFrame([(i, f"http://{i // 2}/x?{i}", f"<p>text {i // 2}") for i in range(8)], df.schema)
    assert {r.page_id: r.text for r in P.extract(alone).collect()} == {i: f"text {i // 2}" for i in range(8)}


def test_odd_rows(spark):
    rows = [
        (1, None, None), (None, None, "<p>a"), (2, "", ""), (3, "not a url", "<article>x</article>"), (3, "not a url", "<article>x</article>"),
        (4, "http://h/" + "p" * 5000, "<p>" + "long " * 50_000), (5, "http://h", "</p></div>&#x1F600;&#0; <"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'own' as row", "'own' as host", "'own' as text")
    got = P.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    texts = sorted((str(r.page_id), r.text) for r in got.collect())
    assert texts == sorted([("1", ""), ("None", "a"), ("2", ""), ("3", "x"), ("3", "x"), ("4", ("long " * 50_000).strip()), ("5", "\U0001f600� <")])
    assert P.extract(df.limit(0)).count() == 0
