"""Main text of web pages: structure first, then differences to the pages nearest by URL.

A page becomes text lines, one for each block. Lines in menus, headers, footers, sidebars, notices,
adverts, forms and comments are marked by their elements, and so are lines outside the article of a page that
names one (``article`` or ``main``). Then all pages are compared: each page is paired with the pages before and
after it by URL path on its host, the lines of both are aligned by a longest common subsequence, and shared lines go.

A named article guards its text: its paragraphs, headings and quotations stay, since sentences repeat on many pages;
lines of lists and tables go only if both neighbours share them, all others if one does. A page that shares over a quarter
of the guarded lines is a copy and takes nothing away, and an article never loses its last line.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from arbolytics.llm.common import bare, texts_of
from arbolytics.operators.ranking import number_rows
from arbolytics.session import stage

# Element names by role in a page.
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "textarea", "title"}
SKIPPED = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "select", "button", "head", "noscript"}
ARTICLE = {"article", "main"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr",
          "img", "input", "picture", "ruby", "rb", "rt", "rp", "output", "meter", "progress"}
#: How many neighbours must share a line of an article for it to go, by the elements it is in; there are two at most.
WITNESSES = {**dict.fromkeys(("li", "dt", "dd", "td", "th"), 2),
             **dict.fromkeys(("p", "h1", "h2", "h3", "h4", "h5", "h6", "caption", "figcaption", "blockquote", "pre", "math"), 3)}
#: A neighbour that shares more of an article's text is a copy of it.
COPY_SHARE = 0.25
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Words in class, id or role that mark a block as no part of the article.
SKIPPED_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
                 "comments", "consent", "cookie", "cookies", "disclaimer", "footer", "header", "menu", "modal", "nav", "navbar",
                 "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "reply", "replies", "share",
                 "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "complementary", "contentinfo", "search"}

#: In an article, ids of these elements are made from titles; only words for comments mark them.
TITLED = {"h1", "h2", "h3", "h4", "h5", "h6", "section"}
COMMENT_WORDS = {"comment", "comments", "reply", "replies"}

#: In an article, other words count only as a whole class name: "search-results" may be a heading's.
ANYWHERE = COMMENT_WORDS | {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "breadcrumb", "breadcrumbs", "cookie", "cookies",
                            "navbar", "newsletter", "pagination", "popup", "sidebar", "toolbar"}

LAYOUT = ("has-", "with-", "without-", "no-", "is-")

# A quote left open, or a very long one, does not hide the end of its tag.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]{0,10000}\"|'[^']{0,10000}')*+|[^>]*)>", re.S)
MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
WORDS = re.compile(r"[a-z]+")


def is_skipped(tag: str, attributes: str, within: bool = False) -> bool:
    """Whether an element (``within`` an article) is no part of the article."""
    if tag in SKIPPED and not (within and tag == "header"):
        return True
    if not attributes or tag in ARTICLE or tag in {"body", "html"}:
        return False
    if HIDDEN.search(attributes):
        return True
    for attribute, *groups in MARKS.findall(attributes):
        titled = within and tag in TITLED and attribute.lower() == "id"
        marks = COMMENT_WORDS if titled else ANYWHERE if within else SKIPPED_WORDS
        for name in "".join(groups).lower().split():
            # "has-sidebar" and the like describe the page around the block.
            if not name.startswith(LAYOUT) and not marks.isdisjoint(WORDS.findall(name)):
                return True
            if within and not titled and name in SKIPPED_WORDS and name != "header":
                return True
    return False


def is_inline(tag: str) -> bool:
    return tag in INLINE or "-" in tag  # elements of a page's own are inline unless it says otherwise


def lines_of(page: str) -> tuple[list[str], list[bool], list[int], bool]:
    """Text lines in page order, whether each stands in a skipped element, its ``WITNESSES``, and whether the page names its article.

    With a named article, lines outside it count as skipped. Elements left open end with
    the element around them; a skipped element left open ends with its parent.
    """
    lines: list[str] = []
    skipped: list[bool] = []
    inside: list[bool] = []
    needs: list[int] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, skipped, in an article
    parts: list[str] = []
    off = within = named = False

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            lines.append(text)
            skipped.append(off)
            inside.append(within)
            needs.append(max((WITNESSES.get(t, 1) for t, _, _ in stack), default=1))

    at = 0
    while True:
        match = TOKEN.search(page, at)
        parts.append(page[at:match.start()] if match else page[at:])
        if not match:
            break
        at = match.end()
        closing, tag, attributes = match[1], (match[2] or "").lower(), match[3] or ""
        if not tag:
            if match[0].startswith("<![CDATA["):
                parts.append(entities.escape(match[0][9:].removesuffix("]]>")))
            continue
        if not is_inline(tag):
            flush()
        if closing:
            if any(t == tag for t, _, _ in stack):
                if is_inline(tag) and is_block_between(stack, tag):
                    continue
                flush_inline = stack[-1][1] != off
                while stack:
                    t, _, _ = stack.pop()
                    if t == tag:
                        break
                _, new_off, new_within = stack[-1] if stack else ("", False, False)
                if (new_off, new_within) != (off, within) or flush_inline:
                    flush()
                off, within = new_off, new_within
            continue
        if tag in RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or attributes.rstrip().endswith("/"):
            continue
        now_off, now_within = off or is_skipped(tag, attributes, within), within or tag in ARTICLE
        named |= tag in ARTICLE and not off
        if (now_off, now_within) != (off, within):
            flush()
        stack.append((tag, now_off, now_within))
        off, within = now_off, now_within
    flush()
    named = named and any(i and not s for i, s in zip(inside, skipped, strict=True))
    return lines, [s or (named and not i) for s, i in zip(skipped, inside, strict=True)], needs, named


def is_block_between(stack: list[tuple[str, bool, bool]], tag: str) -> bool:
    """Whether a block was opened after the last open ``tag``; an inline end tag does not close it."""
    for t, _, _ in reversed(stack):
        if t == tag:
            return False
        if not is_inline(t):
            return True
    return False


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b`` (equal ends first)."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    known = set(y)
    kept = [i for i, v in enumerate(x) if v in known]
    known = {x[i] for i in kept}
    y = [v for v in y if v in known]
    middle = _bit_rows(x, kept, y) if kept and y else []
    return [*range(head), *(head + i for i in middle), *range(len(a) - tail, len(a))]


def _bit_rows(x: list[int], kept: list[int], y: list[int]) -> list[int]:
    """The longest common subsequence of x[kept] and y, with one integer of bits for each row."""
    places: dict[int, int] = {}
    for j, v in enumerate(y):
        places[v] = places.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows, row = [], full
    for i in kept:
        hit = row & places[x[i]]
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    out, j = [], len(y) - 1
    for k in range(len(kept) - 1, -1, -1):
        before = rows[k - 1] if k else full
        # A 0 bit at j says that y[:j + 1] adds one at j.
        while j >= 0 and rows[k] >> j & 1:
            j -= 1
        if j < 0:
            break
        if before >> j & 1:
            out.append(kept[k])
            j -= 1
    return out[::-1]


def line_hashes(lines: list[str]) -> list[int]:
    return [xxhash.xxh64_intdigest(x) - (1 << 63) for x in lines]


def kept_lines(own: list[int], skipped: list[bool], needs: list[int], named: bool, neighbours: list[list[int]]) -> list[bool]:
    """Which lines stay, from the hashes of the page's lines and those of the pages near by URL."""
    keep = [not s for s in skipped]
    if not named:
        for other in neighbours:
            shared = common_lines(own, other)
            if len(shared) < len(own):  # else the page is a copy of a part of the other one
                for i in shared:
                    keep[i] = False
        return keep
    body = {i for i, k in enumerate(keep) if k and needs[i] > 1} or {i for i, k in enumerate(keep) if k}
    witnesses = [0] * len(own)
    for other in neighbours:
        shared = [i for i in common_lines(own, other) if keep[i]]
        if len(body.intersection(shared)) <= COPY_SHARE * len(body):
            for i in shared:
                witnesses[i] += 1
    left = [k and n < need for k, n, need in zip(keep, witnesses, needs, strict=True)]
    return left if any(left) else keep


def main_text(page: str, neighbours: list[list[int]]) -> str:
    """The main text of one page; ``neighbours`` are line hashes of pages near by URL."""
    lines, skipped, needs, named = lines_of(page)
    keep = kept_lines(line_hashes(lines), skipped, needs, named, neighbours)
    return " ".join(x for x, k in zip(lines, keep, strict=True) if k)


PARSED = ("page_id long, url string, host string, path string, lines array<string>, hashes array<long>, skipped array<boolean>, "
          "needs array<tinyint>, named boolean")


def page_lines(rows: DataFrame) -> DataFrame:
    """Each page's lines, their hashes and marks. Pages are parsed here and nowhere else."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lines_of(page) for page in texts_of(batch.column("html"))]
            lines, skipped, needs, named = map(list, zip(*found, strict=True)) if found else ([], [], [], [])
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in ("page_id", "url", "host", "path")}, "lines": pa.array(lines, pa.list_(pa.string())),
                "hashes": pa.array(map(line_hashes, lines), pa.list_(pa.int64())), "skipped": pa.array(skipped, pa.list_(pa.bool_())),
                "needs": pa.array(needs, pa.list_(pa.int8())), "named": pa.array(named, pa.bool_())})

    return rows.mapInArrow(parse, PARSED)


def changed_pages(parsed: DataFrame) -> DataFrame:
    """host, same and keep (per line) of the distinct pages that lose lines to their neighbours.

    Pages with the same lines on a host count once, so a page is not compared with its copies.
    Positions come from a sort over all tasks; a host of any size is no single group.
    """
    marks = ["hashes", "skipped", "needs", "named"]
    distinct = (parsed.filter(F.size("hashes") > 0).groupBy("host", "same").agg(F.min(F.struct("path", *marks)).alias("p"))
                .select("host", "same", "p.path", *[f"p.{c}" for c in marks]))
    placed = stage(number_rows(distinct, [F.col("host"), F.col("path"), F.col("same")], "place"), "page-order")
    before, after = (placed.select((F.col("place") + step).alias("place"), F.col("host").alias(f"host{step}"), F.col("hashes").alias(f"lines{step}"))
                     for step in (1, -1))
    none = F.array().cast("array<array<long>>")
    near = F.concat(*[F.when(F.col("host").eqNullSafe(F.col(f"`host{step}`")) & F.col(f"`lines{step}`").isNotNull(),
                             F.array(F.col(f"`lines{step}`"))).otherwise(none) for step in (1, -1)])
    joined = placed.join(before, "place", "left").join(after, "place", "left").select("host", "same", *marks, near.alias("neighbours"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                keep = kept_lines(row["hashes"], row["skipped"], row["needs"], row["named"], row["neighbours"])
                if any(k == s for k, s in zip(keep, row["skipped"], strict=True)):
                    out.append({"host": row["host"], "same": row["same"], "keep": keep})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("host", pa.string()), ("same", pa.int64()), ("keep", pa.list_(pa.bool_()))]))

    return joined.filter(F.size("neighbours") > 0).mapInArrow(decide, "host string, same long, keep array<boolean>")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row.

    Null or empty html gives empty text. A null URL counts as an own host. A page without
    a neighbour on its host keeps all lines that its elements do not mark. Equal rows get equal results;
    ties in path are ordered by content. Extra columns are left out, an empty table gives none.
    """
    rows = bare(pages, page_id=id_col, url=url_col, html=html_col).select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.select(
        "page_id", "url", "html",
        F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)).alias("host"),
        F.regexp_extract("url", r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1).alias("path"))
    parsed = stage(page_lines(rows), "page-lines").withColumn("same", F.xxhash64("host", "hashes", "skipped", "needs", "named"))
    changed = stage(changed_pages(parsed), "page-changes").withColumnsRenamed({"host": "host_c", "same": "same_c"})
    found = parsed.join(changed, F.col("host").eqNullSafe(F.col("host_c")) & (F.col("same") == F.col("same_c")), "left")
    text = F.array_join(F.filter("lines", lambda x, i: F.coalesce(F.get("keep", i), ~F.get("skipped", i))), " ")
    return found.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
