"""Main text of web pages: structure of the page and differences to its nearest neighbours.

Pages of a host are ordered by the path of their URL, and each is compared with the next one:
their text lines are aligned by longest common subsequence, and lines that both have are
deleted.  Copies are no neighbours: pages of a host with the same lines are one page here, and
pages that share ``COPY_SHARE`` of their characters delete nothing of each other; each page of
a run of those is compared with the pages before and after the run.  What a page itself marks as its article is kept even if a neighbour repeats it, and
what it marks as menu, advert, footer and so on goes even if no neighbour has it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwake.llm.common import slices
from cartwake.llm.components import stars
from cartwake.sources.files import stored

# Kinds of lines; text of the last kind is part of no line.
OUT, OPEN, MAIN, SKIP = 0, 1, 2, -1

#: Neighbours that share so much of the characters of both are copies.
COPY_SHARE = 0.9

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>", re.S
)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_ROLE = re.compile(r"role\s*=\s*[\"']?(?:main|article)\b", re.I)
_PART = re.compile(r"[^a-z0-9]+")

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
OUTSIDE = frozenset(
    "head nav footer aside form menu dialog button select input label fieldset svg canvas object audio video map "
    "datalist search".split()
)
# An open element that a start tag of these names ends.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
# Words in class, id and role that mark a part as no main text.
MARKS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar widget footer contentinfo complementary cookie cookies consent gdpr notice notices "
    "alert popup modal dialog overlay newsletter subscribe subscription signup login search share sharing social related "
    "recommended comment comments commentlist disqus respond reply replies form pagination pager toolbar skip masthead".split()
)
# These mark a page's head, but belong to the text inside an article.
HEADS = frozenset("header banner masthead".split())


def _marked(attrs: str, inside: bool) -> bool:
    if _HIDDEN.search(attrs):
        return True
    for value in _NAMED.findall(attrs):
        words = set(_PART.split(value.lower()))
        if words & MARKS - (HEADS if inside else frozenset()) or not inside and "header" in words:
            return True
    return False


def lines_of(html: str | None, with_out: bool = True) -> list[tuple[str, int]]:
    """(text, kind) of each block that has text, in page order.

    White space inside a block is one space, character references are decoded.  Without
    ``with_out``, blocks outside the main text are left out.
    """
    html = html or ""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []
    kind = held_kind = OPEN
    at, size = 0, len(html)

    def close() -> None:
        if held:
            text = " ".join(unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, held_kind))

    while at < size:
        m = _TOKEN.search(html, at)
        start = m.start() if m else size
        if start > at and (kind > OUT or kind == OUT and with_out):
            if not held:
                held_kind = kind
            held.append(html[at:start])
        if not m:
            break
        at, name = m.end(), m[2]
        if name is None:
            continue
        if m[0].count("<") > 1:
            # A quote that is never closed has swallowed tags.
            m = _TAG.match(html, start)
            at, name = m.end(), m[2]
        name, attrs = name.lower(), m[3]
        if name in BLOCKS:
            close()
        elif name == "br" and held:
            held.append(" ")
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    kind = stack[i - 1][1] if i else OPEN
                    del stack[i:]
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>|\Z", re.I).search(html, at)
            at = end.end()
            continue
        if name in BLOCKS:
            # A block ends an open paragraph; items, cells and rows end their like.
            ends = ENDS.get(name, ())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in ends:
                    kind = stack[i - 1][1] if i else OPEN
                    del stack[i:]
                elif stack[i][0] in BLOCKS:
                    break
        if name in VOID or attrs.endswith("/"):
            continue
        if kind > OUT:
            inside = kind == MAIN
            if name in OUTSIDE or name == "header" and not inside or attrs and _marked(attrs, inside):
                # Inline parts are cut out of their line.
                kind = OUT if name in BLOCKS else SKIP
            elif name in ("article", "main") or attrs and _ROLE.search(attrs):
                kind = MAIN
        stack.append((name, kind))
    close()
    return out


def main_text(lines: list[tuple[str, int]], deleted: set[int] = frozenset()) -> str:
    """The article's lines, or without an article the open lines that are not deleted."""
    if any(k == MAIN for _, k in lines):
        return "\n".join(t for t, k in lines if k == MAIN)
    opened = [t for t, k in lines if k]
    return "\n".join(t for i, t in enumerate(opened) if i not in deleted)


# -- longest common subsequence ---------------------------------------------
def _ends(a: list, b: list) -> np.ndarray:
    """Length of the common subsequence of ``a`` with each prefix of ``b``."""
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes((len(b) + 7) // 8, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def _table(a: list, b: list) -> list[tuple[int, int]]:
    rows = [[0] * (len(b) + 1)]
    for x in a:
        last, row = rows[-1], [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[j], last[j + 1]))
        rows.append(row)
    i, j, out = len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif rows[i - 1][j] >= rows[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def _split(a: list, b: list) -> list[tuple[int, int]]:
    # Halving needs memory for one row only, whatever the lengths.
    if not a or not b:
        return []
    if len(a) * len(b) <= 40_000 or len(a) == 1:
        return _table(a, b)
    mid = len(a) // 2
    cut = int(np.argmax(_ends(a[:mid], b) + _ends(a[mid:][::-1], b[::-1])[::-1]))
    return _split(a[:mid], b[:cut]) + [(i + mid, j + cut) for i, j in _split(a[mid:], b[cut:])]


def common(a: list, b: list) -> list[tuple[int, int]]:
    """Places in ``a`` and ``b`` of a longest common subsequence."""
    both = set(a) & set(b)
    if not both:
        return []
    own = [i for i, x in enumerate(a) if x in both]
    other = [j for j, x in enumerate(b) if x in both]
    return [(own[i], other[j]) for i, j in _split([a[i] for i in own], [b[j] for j in other])]


# -- the job ----------------------------------------------------------------
def _host(url: Column) -> Column:
    host = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def _path(url: Column) -> Column:
    path = F.regexp_extract(url, r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def _row(page_id: str, url: str, html: str) -> Column:
    return F.xxhash64(page_id, url, html)


def _hashes(pages: DataFrame) -> DataFrame:
    """``host``, ``path``, ``row`` and the hashes, kinds and lengths of each page's lines."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            hashes, kinds, sizes = [], [], []
            for html in batch.column("html").to_pylist():
                lines = lines_of(html)
                hashes.append([xxhash.xxh64_intdigest(t) - (1 << 63) for t, _ in lines])
                kinds.append(bytes(k for _, k in lines))
                sizes.append([len(t) for t, _ in lines])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("host", "path", "row")), pa.array(hashes, pa.list_(pa.int64())),
                    pa.array(kinds, pa.binary()), pa.array(sizes, pa.list_(pa.int32())),
                ],
                ["host", "path", "row", "hashes", "kinds", "sizes"],
            )

    return pages.select("host", "path", "row", "html").mapInArrow(
        work, "host string, path string, row long, hashes array<long>, kinds binary, sizes array<int>"
    )


def _open_places(kinds: bytes, places: list[int]) -> list[int]:
    """Places among the open lines that a page without an article loses."""
    if MAIN in kinds:
        return []
    rank = np.cumsum(np.frombuffer(kinds, np.uint8) != OUT) - 1
    return [int(rank[i]) for i in places if kinds[i] != OUT]


def _copies(a: dict, b: dict, shared: list[tuple[int, int]]) -> bool:
    """Whether the common lines are nearly all of both pages."""
    for page, side in ((a, 0), (b, 1)):
        opened = sum(n for n, k in zip(page["sizes"], page["kinds"]) if k != OUT)
        both = sum(page["sizes"][p[side]] for p in shared if page["kinds"][p[side]] != OUT)
        if not opened or both < COPY_SHARE * opened:
            return False
    return True


def _compare(a: dict | None, b: dict) -> list[dict]:
    """What two neighbours delete, and whether they are copies."""
    if a is None or a["host"] != b["host"]:
        return []
    shared = common(a["hashes"], b["hashes"])
    if _copies(a, b, shared):
        return [_found("copies", a["row"], b["row"])]
    return [
        _found("differ", a["row"], b["row"], _open_places(a["kinds"], [i for i, _ in shared])),
        _found("differ", b["row"], a["row"], _open_places(b["kinds"], [j for _, j in shared])),
    ]


_FOUND = (
    "what string, part int, last boolean, host string, row long, other long, hashes array<long>, kinds binary, "
    "sizes array<int>, places array<int>"
)
_FOUND_ARROW = pa.schema([
    ("what", pa.string()), ("part", pa.int32()), ("last", pa.bool_()), ("host", pa.string()), ("row", pa.int64()), ("other", pa.int64()),
    ("hashes", pa.list_(pa.int64())), ("kinds", pa.binary()), ("sizes", pa.list_(pa.int32())), ("places", pa.list_(pa.int32())),
])
_PAGE = ["host", "row", "hashes", "kinds", "sizes"]


def _edge(part: int, last: bool, row: dict) -> dict:
    return dict.fromkeys(_FOUND_ARROW.names) | {"what": "edge", "part": part, "last": last} | {c: row[c] for c in _PAGE}


def _found(what: str, row: int, other: int, places: list[int] | None = None) -> dict:
    return dict.fromkeys(_FOUND_ARROW.names) | {"what": what, "row": row, "other": other, "places": places}


def _compared(pairs: DataFrame) -> DataFrame:
    """Findings for pages ``a`` and ``b``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([f for x in batch.to_pylist() for f in _compare(x["a"], x["b"])], _FOUND_ARROW)

    return pairs.select("a", "b").mapInArrow(work, _FOUND)


def _outside(ones: DataFrame, met: DataFrame) -> DataFrame:
    """Deletions in runs of copies, by the pages before and after each run."""
    roots = stars(met.where("what = 'copies'"), "row", "other").withColumnsRenamed({"u": "row", "v": "root"})
    member = stored(roots.unionByName(roots.select(F.col("root").alias("row"), "root").distinct()), "page-copies")
    ends = met.where("what = 'differ'").select("row", "other").join(member, "row").select("root", "other").distinct()
    page = F.struct(*_PAGE)
    a = ones.select(F.col("row").alias("own"), page.alias("a"))
    b = ones.select(F.col("row").alias("other"), page.alias("b"))
    pairs = member.withColumnRenamed("row", "own").join(ends, "root").join(a, "own").join(b, "other")
    own = member.select("row").join(_compared(pairs).where("what = 'differ'"), "row")
    # The page outside has its own neighbours; of each pair only the copy's side counts here.
    return own.join(member, "row").join(ends, ["root", "other"], "left_semi").select("row", "places")


def shared_lines(pages: DataFrame) -> DataFrame:
    """``row`` and ``places``: open lines that a page shares with a neighbour.

    Pages of a host with the same lines are one.  Pages are sorted by host and path over all
    tasks, so a host of any size is spread evenly.  The first and last page of each task
    meet those of the next in a second step, which has two rows per task; where the tasks'
    limits lie does not matter.
    """
    hashed = stored(_hashes(pages).withColumn("lines", F.xxhash64("hashes", "kinds")), "page-lines")
    first = hashed.groupBy("host", "lines").agg(F.min(F.struct("path", "row")).alias("f"))
    first = first.select("host", "lines", "f.path", "f.row")
    ones = hashed.join(first.select("row"), "row", "left_semi").dropDuplicates(["row"])
    ones = stored(ones.select("path", *_PAGE), "page-lists")
    order = ["host", "path", "row"]
    ordered = ones.repartitionByRange(*order).sortWithinPartitions(*order)

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if before is None:
                    out.append(_edge(part, False, row))
                out += _compare(before, row)
                before = row
            yield pa.RecordBatch.from_pylist(out, _FOUND_ARROW)
        if before is not None:
            yield pa.RecordBatch.from_pylist([_edge(part, True, before)], _FOUND_ARROW)

    found = stored(ordered.mapInArrow(inner, _FOUND), "page-neighbours")
    before = Window.orderBy("part", "last")
    side = F.struct(*_PAGE)
    edges = found.where("what = 'edge'").select("part", "last", side.alias("b"), F.lag(side).over(before).alias("a"))
    # Between tasks only: a task's first row follows the last row of the one before.
    between = _compared(edges.where("not last and a is not null"))
    columns = ["what", "row", "other", "places"]
    met = stored(found.where("what <> 'edge'").select(columns).unionByName(between.select(columns)), "page-met")
    every = met.where("what = 'differ'").select("row", "places")
    if met.where("what = 'copies'").take(1):
        every = every.unionByName(_outside(ones, met))
    lost = every.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("places")).where("size(places) > 0")
    # All pages with the lines of one lose what it loses.
    lost = first.select("host", "lines", "row").join(lost, "row").select("host", "lines", "places")
    return hashed.select("host", "lines", "row").distinct().join(lost, ["host", "lines"]).select("row", "places")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null and empty html give an empty text; a page without a url belongs to the host "".
    Repeated rows stay and are one page to their neighbours.  Other columns are not read.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"),
        _host(F.col(url)).alias("host"), _path(F.col(url)).alias("path"), _row(page_id, url, html).alias("row"),
    )
    lost = stored(shared_lines(rows), "page-shared")
    joined = rows.select("page_id", "url", "html", "row").join(lost, "row", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [
                main_text(lines_of(h, with_out=False), set(p or ()))
                for h, p in zip(batch.column("html").to_pylist(), batch.column("places").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    schema = joined.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return joined.mapInArrow(work, schema)
