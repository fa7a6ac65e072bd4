"""Main text of web pages by nearest-URL page differencing.

Pages are sorted by host and path, so a page's neighbours are those whose URLs share the
longest path with it. The page's text lines (blocks) are aligned with the nearest different
page's by longest common subsequence; what both have is the site's, not the page's. Pages that
follow each other, each a copy of the one before, are a family; their nearest different page
is the one before or after the family, however long that is.

Two votes decide on a line. Differencing: a part of the page (an element with parts of its
own) most of whose text is shared is the site's frame and goes, with or without markup that
says so, and outside an article element every shared line goes. Markup: lines in navigation,
adverts, forms, comments and the like go in any case, which one pair of pages cannot show, and
single shared lines inside an article's own part stay, since pages do quote the same sentences.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, table

#: Share of either page's text that, found in the other, makes the two copies of one page; share
#: of a part's text that, aligned with the neighbour's, makes it the site's frame.
COPY, FRAME = 0.8, 0.5
#: Pages on either side of a range's edge that are looked at first for a family's end; where these
#: are all one family, the whole ranges beside the edge are.
NEAR_EDGE = 8
#: Bits of alignment history held at once; longer pairs are halved first.
HISTORY_BITS = 400_000_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]*+))?+)*+)>|(?P<text>[^<]++)|<",
    re.S,
)
#: A tag up to the next '>', for one whose quoted value holds the page's last '>'.
CUT_TAG = re.compile(r"<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>[^>]*+)>")
TAG_OPEN = re.compile(r"</?[a-zA-Z]|</")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# HTML's element kinds and the names that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
BLOCKS = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - {"br", "body", "html", "option", "td", "th", "tr", "tbody", "thead", "tfoot"}
NOT_TEXT = frozenset("head script style noscript template iframe svg canvas object embed audio video map nav aside footer form button select input textarea dialog menu datalist".split())
ARTICLE_ROLES = frozenset("main article".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NOT_ARTICLE = frozenset("ad ads advert advertisement adverts advertising adsbygoogle banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices overlay pager pagination paywall popup promo promoted promotion register related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split())
ARTICLE_NAMES = frozenset("article layout main page post story".split())
BESIDE = frozenset("free has no with without".split())
PARTS = frozenset("address article aside body div dl fieldset footer form header hgroup main menu nav ol search section table ul".split())
PARTS = frozenset("address article aside body div dl fieldset footer form header hgroup main menu nav ol search section table ul".split())
PARTS = frozenset("address article aside body div dl fieldset footer form header hgroup main menu nav ol search section table ul".split())
PARTS = frozenset("address article aside body div dl fieldset footer form header hgroup main menu nav ol search section table ul".split())


@dataclass
class Page:
    """Text lines in page order; marks: article, open or dropped; links: share of link text.

    ``parts`` numbers the innermost part (an element of PARTS) that a line is in; ``own`` are
    the parts that are articles themselves.
    """

    lines: list[str] = field(default_factory=list)
    marks: list[str] = field(default_factory=list)
    links: list[float] = field(default_factory=list)
    parts: list[int] = field(default_factory=list)
    own: set[int] = field(default_factory=set)


def _is_other(name_list: str, in_article: bool) -> bool:
    """Whether one of an element's class or id names marks it as not the article.

    The last word of a name says what the element is, the first what it belongs to; a name
    that says what the element goes with or without says nothing of it.
    """
    other = NOT_ARTICLE - {"header", "banner"} if in_article else NOT_ARTICLE
    for name in name_list.split():
        parts = [p for p in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if p]
        if parts and not BESIDE & set(parts) and (parts[-1] in other or (parts[0] in other and parts[-1] not in ARTICLE_NAMES)):
            return True
    return False


def _mark_of(tag: str, attrs: str, inherited: str) -> str:
    """The mark of an element's text: once dropped always dropped, and an article's inside is the article."""
    if inherited == "dropped" or tag in NOT_TEXT or (tag == "header" and inherited != "article"):
        return "dropped"
    if attrs and not attrs.isspace():
        got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)}
        role = got.get("role", "").lower()
        if "hidden" in got or role in OTHER_ROLES or re.search(r"display\s*:\s*none", got.get("style", "")):
            return "dropped"
        if tag not in ("html", "body", "main", "article") and any(_is_other(got.get(k, ""), inherited == "article") for k in ("class", "id")):
            return "dropped"
        if role in ARTICLE_ROLES or "articlebody" in got.get("itemprop", "").lower():
            return "article"
    return "article" if tag in ("article", "main") else inherited


def parse(source: str | None) -> Page:
    """Lines of a page. Broken, cut off or missing markup never fails: what is there is read as browsers do.

    A quote opens a value only after '='; one that is never closed is a part of the value
    like any character, so its tag ends at the next '>' and the page goes on.
    """
    page, source = Page(), source or ""
    stack: list[tuple[str, str, int]] = []  # tag, mark, part
    buffer: list[str] = []
    chars = linked = 0
    at, size = 0, len(source)

    def flush(mark: str) -> None:
        nonlocal chars, linked
        if line := " ".join("".join(buffer).split()):
            page.lines.append(line)
            page.marks.append(mark)
            page.links.append(linked / max(1, chars))
            page.parts.append(part)
        buffer.clear()
        chars = linked = 0

    mark, part, parts = "open", 0, 0
    while at < size:
        m = TOKEN.match(source, at)
        text = m["text"]
        if m[0] == "<" and TAG_OPEN.match(source, at):
            m = CUT_TAG.match(source, at)
            if m is None:
                break  # a tag that the end of the page cuts off
        at = m.end()
        tag = m["tag"]
        if tag is None and (text is not None or m[0] == "<"):
            got = html.unescape(text or "<")
            buffer.append(got)
            chars += len(got)
            linked += len(got) * any(t == "a" for t, _, _ in stack)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            flush(mark)
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        else:
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        del stack[k:]
                        break
                    if stack[k][0] in BLOCKS:
                        break
            outer = stack[-1][1] if stack else "open"
            inside = stack[-1][2] if stack else 0
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else size
            elif tag not in VOID and not m["attrs"].rstrip().endswith("/"):
                new = _mark_of(tag, m["attrs"], outer)
                if new != outer and tag not in BLOCKS:
                    flush(mark)
                if tag in PARTS:
                    parts += 1
                    inside = parts
                    if new == "article" != outer:
                        page.own.add(inside)
                stack.append((tag, new, inside))
        now, there = stack[-1][1:] if stack else ("open", 0)
        if (now, there) != (mark, part):
            flush(mark)
            mark, part = now, there
    flush(mark)
    return page


def _rows(a: list[int], places: dict[int, int], full: int, keep: bool) -> list[int]:
    """Bit-parallel LCS rows of ``a`` against the text whose places are given (the last, or all)."""
    v, rows = full, [full]
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
        if keep:
            rows.append(v)
    return rows if keep else [v]


def _lengths(v: int, n: int) -> np.ndarray:
    """LCS lengths against the first 0..n items, from a row: its zero bits, summed up."""
    bits = np.unpackbits(np.frombuffer(v.to_bytes(n // 8 + 1, "little"), dtype=np.uint8), bitorder="little")[:n]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def aligned(a: list[int], b: list[int], start: int = 0) -> Iterator[int]:
    """Positions of ``a`` (plus ``start``) that are in a longest common subsequence with ``b``."""
    if not a or not b:
        return
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    if len(a) * len(b) > HISTORY_BITS and len(a) > 1:
        half = len(a) // 2
        back: dict[int, int] = {}
        for j, x in enumerate(reversed(b)):
            back[x] = back.get(x, 0) | 1 << j
        ahead = _lengths(_rows(a[:half], places, full, False)[0], len(b))
        behind = _lengths(_rows(a[:half - 1:-1], back, full, False)[0], len(b))[::-1]
        cut = int(np.argmax(ahead + behind))
        yield from aligned(a[:half], b[:cut], start)
        yield from aligned(a[half:], b[cut:], start + half)
        return
    rows = _rows(a, places, full, True)
    i, j = len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            yield start + i
        else:
            i -= 1


def shared_lines(page: Page, other: Page | None) -> set[int]:
    """Positions of the page's lines that align with the other page's."""
    if other is None:
        return set()
    code: dict[str, int] = {}
    a, b = ([code.setdefault(x, len(code)) for x in p.lines] for p in (page, other))
    return set(aligned(a, b))


def frame_parts(page: Page, shared: set[int]) -> set[int]:
    """The parts most of whose text is shared, but for articles' own."""
    all_chars, shared_chars = Counter(), Counter()
    for k, part in enumerate(page.parts):
        all_chars[part] += len(page.lines[k])
        shared_chars[part] += len(page.lines[k]) * (k in shared)
    return {part for part, n in shared_chars.items() if n > FRAME * all_chars[part] and part not in page.own}


def main_text(page: Page, other: Page | None) -> tuple[str, int]:
    """The page's text after differencing with another page, and how many lines the two share."""
    shared = shared_lines(page, other)
    frames = frame_parts(page, shared)
    article = any(m == "article" for m in page.marks)
    kept = []
    for k, line in enumerate(page.lines):
        if page.marks[k] == "dropped":
            gone = True
        elif page.marks[k] == "article":
            gone = page.parts[k] in frames or (k in shared and page.links[k] > 0.5)
        else:
            gone = article or k in shared
        if not gone:
            kept.append(line)
    return " ".join(kept), len(shared)


def copies(a: Page, b: Page) -> bool:
    """Whether two pages are copies of one: most lines and most text of either are in the other, wherever they stand.

    Lines that markup drops do not count.
    """
    return _alike(_counted(a), _counted(b), len)


def _counted(page: Page) -> list[str]:
    return [x for x, m in zip(page.lines, page.marks) if m != "dropped"]


def _alike(own: list, other: list, size: Callable[[Any], int]) -> bool:
    """``copies`` of two lists of lines, or of what stands for lines, of the sizes given."""
    both = list((Counter(own) & Counter(other)).elements())
    most_lines = len(both) >= COPY * max(len(own), len(other))
    return most_lines and sum(map(size, both)) >= COPY * max(sum(map(size, own)), sum(map(size, other)))


def digest(source: str | None) -> bytes:
    """What ``copies`` needs of a page: 20 bytes a line, its hash and its length."""
    lines = _counted(parse(source))
    return b"".join(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=16).digest() + len(x).to_bytes(4, "little") for x in lines)


def copies_by_digest(a: bytes, b: bytes) -> bool:
    """``copies`` of the pages with these digests."""
    own, other = ([d[k : k + 20] for k in range(0, len(d), 20)] for d in (a, b))
    return a == b or _alike(own, other, lambda x: int.from_bytes(x[16:], "little"))


def host_and_path(url: str | None) -> tuple[str, list[str]]:
    """Host and path segments (the query split off, the fragment left out) of a URL."""
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^#]*)", url or "")
    return (m[1].lower(), [x for x in re.split(r"[/?&]", m[2]) if x]) if m else ("", [x for x in re.split(r"[/?&]", url or "") if x])


def _common(a: list[str], b: list[str]) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


Row = tuple[int, bool, int | None, str | None, str | None]


Row = tuple[int, bool, int | None, str | None, str | None]


Row = tuple[int, bool, int | None, str | None, str | None]


Row = tuple[int, bool, int | None, str | None, str | None]


def difference(rows: Iterator[Row]) -> Iterator[tuple[int | None, str | None, str, int]]:
    """(page_id, url, text, shared lines) of the rows (range, inside, page_id, url, html) that are inside.

    Rows come range by range, in each sorted by host and path. Pages that follow each other,
    each a copy of the one before, are a family: all are differenced with the last page before
    the family or the first after it, whichever's URL is nearer. Rows that are not inside are
    the page before the range's first family and the one after its last, though these may
    reach over the range's edges. Of a family's pages only compressed differences are held.
    """
    before: tuple[str, list[str], Page] | None = None
    last_page: tuple[str, list[str], Page] | None = None
    now, own, head = None, False, b""
    members: list[tuple[int | None, str | None, bytes]] = []

    def pack(source: str) -> bytes:
        squeeze = zlib.compressobj(6, zdict=head)
        return squeeze.compress(source.encode("utf-8", "surrogatepass")) + squeeze.flush()

    def settle(after: tuple[str, list[str], Page] | None) -> Iterator[tuple[int | None, str | None, str, int]]:
        near = [x for x in (before, after) if x is not None and x[0] == last_page[0]]
        last: tuple[bytes, list[str], tuple[str, int]] | None = None
        for page_id, url, packed in members:
            path = host_and_path(url)[1]
            if last is None or last[:2] != (packed, path):
                source = zlib.decompressobj(zdict=head).decompress(packed).decode("utf-8", "surrogatepass")
                other = max(near, key=lambda x: _common(path, x[1]), default=None)
                last = packed, path, main_text(parse(source), other[2] if other else None)
            yield page_id, url, *last[2]

    for span, inside, page_id, url, source in rows:
        source = source or ""
        host, path = host_and_path(url)
        new = (host, path, parse(source))
        if last_page is None or span != now or not (own and inside) or host != last_page[0] or not copies(last_page[2], new[2]):
            if last_page is not None:
                yield from settle(new if span == now else None)
            before = last_page if span == now else None
            members, now, head = [], span, source.encode("utf-8", "surrogatepass")[-32768:]
        last_page, own = new, inside
        if inside:
            members.append((page_id, url, pack(source)))
    if last_page is not None:
        yield from settle(None)


Key = tuple[bytes, bytes, int, int]
#: A key and the hash of the page, which tells pages of equal keys apart.
Exact = tuple[bytes, bytes, int, int, int]
SORT = ["host", "path", "page_id", "tie"]


def _key(host: str, path: str, page_id: int | None) -> Key:
    """A key in the order that Spark sorts: by bytes, nulls first."""
    return host.encode(), path.encode(), page_id is not None, page_id or 0


def _ranges(keys: DataFrame) -> list[tuple[list[Key], list[Key]]]:
    """The first and the last NEAR_EDGE keys (host, path, page_id) of every range, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = [], []
        for batch in batches:
            rows = batch.to_pylist()
            first = (first + rows)[:NEAR_EDGE]
            last = (last + rows)[-NEAR_EDGE:]
        sides = [False] * len(first) + [True] * len(last)
        rows = first + last
        yield pa.RecordBatch.from_arrays(
            [pa.array(sides, pa.bool_()), *(pa.array([r[c] for r in rows], t) for c, t in (("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64())))],
            names=["end", "host", "path", "page_id"],
        )

    # Several ranges a partition of the second shuffle, which deals them by hash.
    ranges = 4 * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartitionByRange(ranges, "host", "path", "page_id").sortWithinPartitions("host", "path", "page_id")
    found = dealt.mapInArrow(run, "end boolean, host string, path string, page_id long").withColumn("part", F.spark_partition_id())
    out: dict[int, tuple[list[Key], list[Key]]] = {}
    for r in found.collect():
        out.setdefault(r.part, ([], []))[r.end].append(_key(r.host, r.path, r.page_id))
    return sorted(out.values())


def _deal(keyed: DataFrame, kind: str, give: Callable[[Exact], list[dict]]) -> DataFrame:
    """Every row once for each struct (of type ``kind``) that ``give`` makes of its key, with the struct's fields first."""

    @F.arrow_udf(f"array<struct<{kind}>>")
    def given(hosts: pa.Array, paths: pa.Array, ids: pa.Array, ties: pa.Array) -> pa.Array:
        out = [give((*_key(h, p, i), t)) for h, p, i, t in zip(*(x.to_pylist() for x in (hosts, paths, ids, ties)))]
        types = {"int": pa.int32(), "boolean": pa.bool_()}
        return pa.array(out, pa.list_(pa.struct([(n, types[t]) for n, t in (x.split(":") for x in kind.split(","))])))

    return keyed.withColumn("at", F.explode(given(*SORT))).select("at.*", "page_id", "url", "html", "host", "path", "tie")


def _family_ends(keyed: DataFrame, give: Callable[[Exact], list[dict]]) -> dict[tuple[int, int, str], Exact]:
    """Where families end in groups of pages that follow each other, dealt by ``give`` as (group, span).

    Of each (group, span): the page before the last end inside the span ("last"), the page
    after the first one ("first"), and the pages before and after an end between this span
    and the next ("left", "right").
    """
    fields = (("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()), ("tie", pa.int64()))
    names = ["group", "span", *SORT]

    def brief(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([digest(x.as_py()) for x in batch.column("html")], pa.binary())
            sites = pa.array([host_and_path(x.as_py())[0] for x in batch.column("url")], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), sites, found], names=[*names, "site", "lines"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict | None = None
        ends: dict[tuple[int, str], dict] = {}

        def out() -> pa.RecordBatch:
            rows = list(ends.items())
            return pa.RecordBatch.from_arrays(
                [pa.array([last["group"]] * len(rows), pa.int32()), pa.array([k[0] for k, _ in rows], pa.int32()), pa.array([k[1] for k, _ in rows], pa.string()),
                 *(pa.array([r[n] for _, r in rows], t) for n, t in fields)],
                names=["group", "span", "what", *SORT],
            )

        for batch in batches:
            for k in range(batch.num_rows):
                new = {n: batch.column(n)[k].as_py() for n in (*names, "site", "lines")}
                if last is not None and new["group"] != last["group"]:
                    yield out()
                    ends = {}
                elif last is not None and (new["site"] != last["site"] or not copies_by_digest(last["lines"], new["lines"])):
                    span = last["span"]
                    if new["span"] == span:
                        ends[span, "last"] = last
                        ends.setdefault((span, "first"), new)
                    else:
                        ends[span, "left"], ends[span, "right"] = last, new
                last = new
        if ends:
            yield out()

    briefs = bounded(_deal(keyed, "group:int,span:int", give)).mapInArrow(brief, "group int, span int, host string, path string, page_id long, tie long, site string, lines binary")
    dealt = briefs.repartition("group").sortWithinPartitions("group", *SORT)
    found = dealt.mapInArrow(scan, "group int, span int, what string, host string, path string, page_id long, tie long")
    return {(r.group, r.span, r.what): (*_key(r.host, r.path, r.page_id), r.tie) for r in found.collect()}


def _beside(keyed: DataFrame, ranges: list[tuple[list[Key], list[Key]]]) -> list[tuple[Exact | None, Exact | None]]:
    """The page before every range's first family and the page after its last one, be they of another host.

    Where a family reaches over an edge, it is followed through as many ranges as it has: the
    pages near the edge are looked at first, and ranges whose pages near it are all of the
    family as a whole. Pages go by as digests; keys alone come to the driver.
    """
    n = len(ranges)
    begins = [first[0] for first, _ in ranges]
    upto = [first[-1] for first, _ in ranges]
    since = [last[0] for _, last in ranges]

    def near_edges(key: Exact) -> list[dict]:
        k = bisect_right(begins, key[:4]) - 1
        out = [{"group": k, "span": k}] if k + 1 < n and key[:4] >= since[k] else []
        return out + ([{"group": k - 1, "span": k}] if k and key[:4] <= upto[k] else [])

    near = _family_ends(keyed, near_edges) if n > 1 else {}
    open_edges = [k for k in range(n - 1) if (k, k, "left") not in near]
    whole = {k for k, (first, last) in enumerate(ranges) if first == last}  # all its pages are near its edges
    left_out = {k for k in open_edges if (k, k, "last") not in near} | {k + 1 for k in open_edges if (k, k + 1, "first") not in near}
    left_out -= whole
    far = _family_ends(keyed, lambda key: [{"group": k, "span": k}] if (k := bisect_right(begins, key[:4]) - 1) in left_out else []) if left_out else {}

    before: list[Exact | None] = [None] * n
    after: list[Exact | None] = [None] * n
    for k in range(1, n):
        got = near.get((k - 1, k - 1, "left")) or near.get((k - 1, k - 1, "last")) or far.get((k - 1, k - 1, "last"))
        before[k] = got or before[k - 1]
    for k in range(n - 2, -1, -1):
        got = near.get((k, k, "right")) or near.get((k, k + 1, "first")) or far.get((k + 1, k + 1, "first"))
        after[k] = got or after[k + 1]
    return list(zip(before, after))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, shared_lines) of every row of ``pages`` (page_id, url, html).

    Pages are dealt by ranges of (host, path, page_id), so no task gets a whole host. The
    ranges' edges are read from the keys alone; each range also gets the nearest different page
    before its first family and after its last one, wherever these are, so the result is that
    of one range of all pages. A null html is an empty page; a null url is a page of the
    nameless host. Rows may repeat: equal pages are copies. A page of any length is read whole;
    the alignment of long pages is halved until its history fits in HISTORY_BITS. Extra columns
    are left out. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[Row]:
            for batch in batches:
                for k in range(batch.num_rows):
                    yield tuple(batch.column(j)[k].as_py() for j in range(5))

        def pack(out: list[tuple[int | None, str | None, str, int]]) -> pa.RecordBatch:
            ids, urls, texts, shared = zip(*out)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(shared, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "shared_lines"],
            )

        held, chars = [], 0
        for row in difference(rows()):
            held.append(row)
            chars += len(row[2])
            if chars > 4_000_000 or len(held) >= 2_000:
                yield pack(held)
                held, chars = [], 0
        if held:
            yield pack(held)

    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_replace(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*", ""), "#.*$", "")
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"),
        host.alias("host"), path.alias("path"),
    ).withColumn("tie", F.xxhash64(F.coalesce("html", F.lit(""))))
    ranges = _ranges(keyed.select("host", "path", "page_id"))
    begins = [first[0] for first, _ in ranges]
    seen: dict[Exact, list[dict]] = {}
    for k, sides in enumerate(_beside(keyed, ranges)):
        for place, key in zip((-1, 1), sides):
            if key:
                seen.setdefault(key, []).append({"span": k, "place": place})

    def spans(key: Exact) -> list[dict]:
        return [{"span": max(0, bisect_right(begins, key[:4]) - 1), "place": 0}, *seen.get(key, [])]

    dealt = _deal(keyed, "span:int,place:int", spans)
    sorted_rows = dealt.repartition("span").sortWithinPartitions("span", "place", *SORT).select("span", F.col("place") == 0, "page_id", "url", "html")
    return bounded(sorted_rows).mapInArrow(run, "page_id long, url string, text string, n_chars long, shared_lines long")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
