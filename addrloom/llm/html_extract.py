"""HTML extraction: nearest-URL page differencing, guided by a page's structure.

A page is cut into lines, one per block of text, and each line is sure, open or dropped. Dropped
are the lines of elements that hold no article text (menus, page headers, footers, sidebars,
notices, adverts, forms, comments...), by tag, role, class or id; scripts and styles give no lines
at all. Where a page marks its article, its paragraphs, headings, list items, quotes and cells are
sure; what else stands in it is open: blocks of no such kind, blocks that are all link, and blocks
with an ambiguous class. On a page without that mark all that isn't dropped is open. A class or id
never drops what holds the page's article or half of its text, nor a paragraph, heading or quote
of the article unless it names an advert.

Every page is paired with the nearest page of its host by URL path that isn't a copy of it; the
lines of both are aligned by longest common subsequence, and open lines that they share are deleted.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bound_batches, by_bytes, stored

# Fixed words of HTML, and of the names that sites give to what isn't article text.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
DROPPED = {"aside", "audio", "button", "canvas", "datalist", "dialog", "fieldset", "footer", "form", "head", "map", "menu", "nav", "object", "option", "select", "svg", "template", "video"}
KEPT = {"html", "body", "article", "main"}
NAMES = {
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "adbox", "banner", "banners", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr",
    "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager", "pagination", "paywall", "popup", "promo", "promoted", "promotion", "recommended", "related", "respond", "share", "sharing",
    "sidebar", "sidebars", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "topbar", "widget", "widgets",
}
# Fixed words that go with such names, as in comment-list or site-footer; and names that also stand for an article's subject.
BESIDE = {"area", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "container", "content", "form", "group", "holder", "icons", "inline", "inner", "item", "items", "js", "left", "link", "links", "list", "main", "outer", "page", "panel", "post", "posts", "reader", "right", "row", "section", "signup", "site", "slot", "slots", "sticky", "thread", "top", "unit", "user", "wrap", "wrapper", "zone"}
AMBIGUOUS = {"banner", "banners", "comment", "consent", "copyright", "menu", "menus", "notice", "notices", "notification", "promotion", "recommended", "related", "respond", "share", "sharing", "skip", "social", "subscription", "widget", "widgets"}
#: Names that say what a block is and never what an article is about; words of names that tell of a page's layout, as in has-sidebar.
ADVERT = {"ad", "ads", "advert", "advertisement", "advertising", "adverts", "promoted", "sponsor", "sponsored"}
COMMENTS = {"comment", "commentlist", "comments", "disqus", "respond"}
LAYOUT = {"disabled", "enabled", "has", "no", "with", "without"}
#: A block named header is the page's unless it is named after the article as well.
HEADER, OF_ARTICLE = "header", {"article", "content", "entry", "post", "story"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Blocks that are sure in a marked article.
TEXT = HEADINGS | {"p", "li", "blockquote", "pre", "td", "th", "caption", "dd", "dt", "figcaption"}
ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search", "toolbar"}
#: What a line is; in a tag's verdict SURE says that its element is left alone, and NAMED that it goes for its class or id, unless it holds the article, READERS that it goes whatever it holds.
SURE, OPEN, GONE, NAMED, READERS = 0, 1, 2, 3, 4

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def verdict(name: str, attributes: str, in_article: bool) -> int:
    """What an element makes of the lines in it: GONE, OPEN, or SURE where it says nothing about them."""
    if name in DROPPED or name == "header" and not in_article:
        return GONE
    if not attributes or name in KEPT and name != "article":
        return SURE
    tokens: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        what, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if what == "hidden" or what == "aria-hidden" and value == "true" or what == "role" and value in ROLES or what == "style" and _HIDDEN.search(value):
            return GONE
        if what == "class" or what == "id" and name not in TEXT:  # the id of a paragraph or heading is made of its words
            tokens.update(value.split())
    if not tokens:
        return SURE
    if name == "article" and not in_article:
        return READERS if tokens and set().union(*(_WORD.findall(t) for t in tokens)) <= COMMENTS | BESIDE and not COMMENTS.isdisjoint(tokens) else SURE
    parts = [p for t in tokens if LAYOUT.isdisjoint(p := {w for w in _WORD.findall(t) if not w[0].isdigit()})]
    named = [p for p in parts if not NAMES.isdisjoint(p)]
    every = set().union(*parts)
    kind = READERS if not COMMENTS.isdisjoint(every) and every <= COMMENTS | BESIDE else NAMED  # readers' comments, however long, hold no article
    if not in_article:
        return kind if named or name not in HEADINGS and HEADER in every and OF_ARTICLE.isdisjoint(every) else SURE
    if not named:
        return SURE
    # Inside the article: a name alone, or with words that only go with one, is clear; beside other words it may be the subject.
    clear = [p for p in named if p <= NAMES | BESIDE]
    if not clear or not (every <= NAMES | BESIDE) and every & NAMES <= AMBIGUOUS or name in TEXT and ADVERT.isdisjoint(every):
        return OPEN  # so is a paragraph, heading or quote with any name but an advert's
    return kind


_QUIET = re.compile(r"<(" + "|".join(sorted(RAW - {"noscript"})) + r")\b.*?(?:</\1\s*>|\Z)", re.S | re.I)


def visible(page: str) -> int:
    """Characters of text, roughly: without markup, scripts and white space."""
    return len(_SPACE.sub("", _TAG.sub("", _QUIET.sub("", page))))


def extent(page: str, at: int, name: str) -> int:
    """Where the element that began before `at` ends, by tags of its own name."""
    depth = 1
    for m in re.compile(rf"<(/?){name}(?=[\s/>])", re.I).finditer(page, at):
        depth += -1 if m[1] else 1
        if not depth:
            return m.start()
    return len(page)


_ARTICLE = re.compile(r"<(?:article|main)[\s>]|<[a-z]+[^>]*\srole\s*=\s*[\"']?main\b", re.I)


def holds_the_text(page: str, at: int, name: str, whole: Callable[[], int], article: bool) -> bool:
    """Whether an element is a wrapper: it holds the page's first article, or half of its text."""
    to = extent(page, at, name)
    return not article and _ARTICLE.search(page, at, to) is not None or 2 * visible(page[at:to]) > whole()


def lines(page: str) -> tuple[list[tuple[str, int]], bool]:
    """The text lines of a page, each with what it is, and whether the page marks its article. No markup, references decoded, white space single."""
    out: list[tuple[str, int, bool]] = []
    block: list[str] = []
    depth = main_depth = at = linked = 0
    article = False
    holder, all_link = "", True  # the innermost block's tag, and whether the block's text so far is all link
    gone, loose = _Inside(), _Inside()  # the element whose lines are dropped, and the one whose lines are open
    size: list[int] = []
    sealed = False  # whether not even an article ends what is dropped
    inline = False  # whether the dropped element is part of a line, which then goes on without it

    def flush() -> None:
        nonlocal all_link
        if block:
            if text := _SPACE.sub(" ", html.unescape("".join(block))).strip():
                kind = GONE if gone.name and not inline else SURE if depth and not loose.name and holder in TEXT and not (all_link and holder not in HEADINGS) else OPEN
                out.append((text, kind, depth > 0))
            block.clear()
        all_link = True

    def whole() -> int:
        if not size:
            size.append(visible(page))
        return size[0]

    def put(text: str) -> None:
        nonlocal all_link
        if not inline:
            block.append(text)
            all_link = all_link and (linked > 0 or not text.strip())

    while m := _TAG.search(page, at):
        if m.start() > at:
            put(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in RAW:  # no markup until its end, and no boundary of a block
            if not closing:
                end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
                at = end.start() if end else len(page)
            continue
        if gone.name and name in ("article", "main") and not closing and gone.name not in ("article", "main") and not depth and not main_depth and not article and not sealed:
            flush()
            gone.name, inline = "", False  # what was to be left out was never closed
        if gone.name:
            before = gone.name
            if not gone.ends(name, closing):
                if name not in INLINE and not inline:
                    flush()
                continue
            gone.name = before  # the text so far is still inside
            if not inline:
                flush()
            gone.name, inline = "", False
            if closing and name == before:
                continue
        if loose.name:
            before = loose.name
            if loose.ends(name, closing):
                loose.name = before
                flush()
                loose.name = ""
        if name not in INLINE:
            flush()
            if closing:
                holder = ""
            elif name not in VOID:
                holder = name
        elif name == "a":
            linked = max(0, linked + (-1 if closing else 1))
        if closing:
            if name == "article" and depth:
                depth -= 1
            elif name == "main" and main_depth:
                main_depth -= 1
            continue
        if name not in VOID and (found := verdict(name, m[3], depth > 0)) and not m[3].rstrip().endswith("/"):
            if found == NAMED:
                found = SURE if name not in INLINE and holds_the_text(page, at, name, whole, article) else GONE
            if found in (GONE, READERS):
                gone.begins(name)
                sealed = found == READERS
                inline = name in INLINE
                if name == "a":
                    linked = max(0, linked - 1)
                continue
            if found == OPEN and not loose.name and name not in INLINE:
                loose.begins(name)
        if name == "article":
            depth, article = depth + 1, True
        elif name == "main":
            main_depth += 1
        elif name == "br":
            put(" ")
    put(page[at:])
    flush()
    return [(text, GONE if article and not inside else kind) for text, kind, inside in out], article


class _Inside:
    """An element and how many of its name are open in it; name is empty while there is none."""

    def __init__(self) -> None:
        self.name, self.open = "", 0

    def begins(self, name: str) -> None:
        self.name, self.open = name, 1

    def ends(self, name: str, closing: bool) -> bool:
        """Takes the next tag into account; whether it ends the element. Paragraphs and list items also end without a tag of their own."""
        if name == self.name:
            self.open += -1 if closing else 1 if name not in ("p", "li") else 0
            over = self.open <= 0 or not closing and name in ("p", "li")
        else:
            over = self.name == "p" and name not in INLINE or self.name == "li" and closing and name in ("ul", "ol")
        if over:
            self.name = ""
        return over


#: Bits of the table of a subsequence that are kept at once.
TABLE_BITS = 1 << 27


def _row(a: list[int], b: list[int]) -> int:
    """Bit k is 0 where the first k + 1 of a have a longer common subsequence with b than the first k."""
    places: dict[int, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = row = (1 << len(a)) - 1
    for y in b:
        u = row & places.get(y, 0)
        row = ((row + u) | (row - u)) & full
    return row


def shared(a: list[int], b: list[int], bits: int = TABLE_BITS) -> list[tuple[int, int]]:
    """Places in a and b of a longest common subsequence. Rows of bits, so its cost is len(a) * len(b) / 64; where their table exceeds `bits`, b is halved and a cut where the halves' sum is largest, so memory stays bounded."""
    head = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    if head:
        return [(k, k) for k in range(head)] + [(i + head, j + head) for i, j in shared(a[head:], b[head:], bits)]
    n = len(a)
    if not n or not b:
        return []
    if n * len(b) > bits and len(b) > 1:
        half = len(b) // 2
        up, down = _row(a, b[:half]), _row(a[::-1], b[half:][::-1])
        left, right = (np.cumsum(np.array([1 - (r >> k & 1) for k in range(n)]) if n < 64 else 1 - np.unpackbits(np.frombuffer(r.to_bytes(-(-n // 8), "little"), np.uint8), bitorder="little")[:n].astype(np.int64)) for r in (up, down))
        total = np.append(0, left) + np.append(0, right)[::-1]
        cut = int(total.argmax())
        return shared(a[:cut], b[:half], bits) + [(i + cut, j + half) for i, j in shared(a[cut:], b[half:], bits)]
    places: dict[int, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    rows, full, row = [], (1 << n) - 1, (1 << n) - 1
    for y in b:
        u = row & places.get(y, 0)
        row = ((row + u) | (row - u)) & full
        rows.append(row)
    # A zero bit k of row j: the first k + 1 lines of a have a longer common part with the first j + 1 of b than the first k have.
    out, k, j = [], n - 1, len(b) - 1
    while k >= 0 and j >= 0:
        if rows[j] >> k & 1:
            k -= 1
        elif j > 0 and not rows[j - 1] >> k & 1:
            j -= 1
        elif a[k] == b[j]:
            out.append((k, j))
            k, j = k - 1, j - 1
        else:
            j -= 1
    return out[::-1]


def _number(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _address(url: str | None) -> tuple[str, str]:
    try:
        u = urlsplit(url or "")
        return (u.hostname or "").lower(), u.path
    except ValueError:
        return "", url or ""


def nearness(a: str, b: str) -> tuple[int, int]:
    """Common leading segments of two paths, then common leading characters."""
    x, y = a.split("/"), b.split("/")
    k = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
    return k, next((i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))


def is_copy(sizes: list[int], both: list[int], mirror: float = 0.6) -> bool:
    """Whether the shared lines hold more than `mirror` of a page's characters: menus and notices are many lines, but short ones."""
    return sum(sizes[k] for k in both) > mirror * sum(sizes)


PARSED = "page_id long, url string, host string, path string, lines array<string>, at array<int>, numbers array<long>, sizes array<int>, open array<int>"


def parse_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: the lines that aren't dropped and their places, then of all lines a number, the size (0: dropped), and the places of the open ones. No shuffle.

    A null or empty page has no lines; a URL that can't be read has the host ''.
    """
    bound_batches(pages.sparkSession)
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_bytes(whole, "html", 4 << 20):
                rows = []
                for u, page in zip(b.column("url").to_pylist(), b.column("html").to_pylist(), strict=True):
                    found, _ = lines(page or "")
                    at = [k for k, (_, kind) in enumerate(found) if kind != GONE]
                    rows.append((*_address(u), [found[k][0] for k in at], at, [_number(x) for x, _ in found], [len(x) if kind != GONE else 0 for x, kind in found], [k for k, (_, kind) in enumerate(found) if kind == OPEN]))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), *columns], [x.split()[0] for x in PARSED.split(", ")])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, PARSED)


#: What a page is known by when pages are compared: its lines and which of them are open.
_CONTENT = ["numbers", "sizes", "open"]


def _compared(pairs: DataFrame) -> DataFrame:
    """rank, near, copy, gone, joined for both pages (structs a and b) of each pair: how near they are, whether the other is a copy, the open lines that both share, and for b whether either is a copy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                a, b = r["a"], r["b"]
                both = shared(a["numbers"], b["numbers"])
                near = dict(zip(("segments", "letters"), nearness(a["path"], b["path"]), strict=True))
                sides = [(a, [i for i, _ in both]), (b, [j for _, j in both])]
                copies = [is_copy(own["sizes"], places) for own, places in sides]
                for (own, places), copy in zip(sides, copies, strict=True):
                    open_ = set(own["open"])
                    out.append((own["rank"], near, copy, [k for k in places if k in open_], own is b and any(copies)))
            near = pa.struct([("segments", pa.int32()), ("letters", pa.int32())])
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), near, pa.bool_(), pa.list_(pa.int32()), pa.bool_()), strict=True)], ["rank", "near", "copy", "gone", "joined"])

    return pairs.select("a", "b").mapInArrow(run, "rank long, near struct<segments:int,letters:int>, copy boolean, gone array<int>, joined boolean")


def _nearest(compared: DataFrame) -> DataFrame:
    """Of each rank's comparisons the nearest with a page that isn't a copy; none if all are."""
    return compared.filter("not copy").groupBy("rank").agg(F.max_by("gone", F.struct("near", F.negative(F.size("gone")), "gone")).alias("gone"))


def _running(spark: SparkSession, rows: DataFrame, part: Column, value: Column) -> DataFrame:
    """Adds _before, the sum of value over all parts before a row's own; parts are few, and the driver sees one sum for each."""
    total, before = 0, []
    for p, n in sorted(tuple(r) for r in rows.groupBy(part.alias("p")).agg(F.sum(value)).collect()):
        before.append((p, total))
        total += n
    return rows.withColumn("_p", part.cast("long")).join(F.broadcast(spark.createDataFrame(before, "_p long, _before long")), "_p").drop("_p")


def differenced(parsed: DataFrame) -> DataFrame:
    """host, c (hash of a page's content) and the places of the open lines that such a page shares with its nearest page.

    Pages of one host with equal lines are one entry, so an exact copy is never a page's
    neighbour. The entries are brought into one order, by host, path and content, over ranges, so
    a hot host spreads like any other; each is compared with the next in that order. An entry
    whose neighbours are all near copies is one of a run of such: it is compared with the last
    entry before the run and the first after it, however long the run is. The driver sees one
    count per range, and one per 65,536 entries.
    """
    spark = parsed.sparkSession
    order = ["host", "path", "c"]
    entries = parsed.groupBy("host", F.xxhash64("numbers", "open").alias("c")).agg(F.min(F.struct("path", *_CONTENT)).alias("e")).select("host", "c", "e.*")
    placed = stored(entries.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    ranked = _running(spark, placed, F.shiftright("_at", 33), F.lit(1)).select(*order, *_CONTENT, (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank"))
    side = F.struct("rank", "host", "path", *_CONTENT)
    own, after = ranked.select("rank", side.alias("a")), ranked.select((F.col("rank") - 1).alias("rank"), side.alias("b"))
    pairs = own.join(after.hint("merge"), "rank").filter("a.host = b.host and (size(a.open) > 0 or size(b.open) > 0)")
    first = stored(_compared(pairs))
    out = _nearest(first)
    lone = ranked.filter("size(open) > 0").join(out.select("rank").hint("merge"), "rank", "left_anti").join(first.select("rank").distinct().hint("merge"), "rank", "left_semi")
    lone = stored(lone.select("rank", "host"))
    if not lone.isEmpty():
        # A run ends where an entry isn't a copy of the next, nor that of it.
        joined = first.filter("joined").select("rank", F.lit(0).alias("_start"))
        block = F.floor(F.col("rank") / 65536)
        starts = stored(ranked.select("rank", "host").join(joined.hint("merge"), "rank", "left").withColumn("_start", F.coalesce("_start", F.lit(1))))
        runs = _running(spark, starts, block, F.col("_start")).withColumn("run", F.col("_before") + F.sum("_start").over(Window.partitionBy(block).orderBy("rank")))
        runs = stored(runs.select("rank", "host", "run"))
        ends = stored(runs.groupBy("run", "host").agg(F.min("rank").alias("begin"), F.max("rank").alias("end")))
        mine = stored(lone.join(runs.select("rank", "run").hint("merge"), "rank"))
        last = mine.join(ends.select((F.col("run") + 1).alias("run"), "host", F.col("end").alias("other")).hint("merge"), ["run", "host"])
        two = last.unionByName(mine.join(ends.select((F.col("run") - 1).alias("run"), "host", F.col("begin").alias("other")).hint("merge"), ["run", "host"]))
        a = two.join(ranked.select("rank", side.alias("a")).hint("merge"), "rank")
        again = a.join(ranked.select(F.col("rank").alias("other"), side.alias("b")).hint("merge"), "other")
        later = _compared(again).join(lone.select("rank").hint("merge"), "rank", "left_semi")
        out = stored(out.unionByName(_nearest(later)))
    return ranked.select("host", "c", "rank").join(out.hint("merge"), "rank").select("host", "c", "gone").filter(F.size("gone") > 0)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars for every page.

    A null or empty page, or one without text, gives an empty text. Pages of one host with equal
    lines give equal texts, whatever their ids; rows that repeat an id are rows like any other.
    Pages without a URL (or a host in it) count as one host. Of equally near pages that with fewer
    shared lines counts. A page that is alone on its host keeps all its open lines.
    """
    parsed = stored(parse_pages(pages, id_col, url_col, html_col))
    gone = stored(differenced(parsed))
    rows = parsed.select("page_id", "url", "host", F.xxhash64("numbers", "open").alias("c"), "lines", "at", F.size("open").alias("n"))
    whole = rows.filter("n = 0").select("page_id", "url", F.array_join("lines", "\n").alias("text"))
    some = rows.filter("n > 0").join(gone.hint("merge"), ["host", "c"], "left")
    kept = F.filter("lines", lambda _, k: ~F.coalesce(F.array_contains("gone", F.element_at("at", k + 1)), F.lit(False)))
    some = some.select("page_id", "url", F.array_join(kept, "\n").alias("text"))
    return whole.unionByName(some).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
