"""Main text of web pages: the article, without what recurs on a site.

Every element gets a hash of its subtree (tags, classes and text). Spark counts on how many
different pages of a host each subtree occurs, wherever it stands in the page; subtrees that recur on
a large share of them are the template of the host and are cut out. What a page alone tells is used
after that: the article element, and elements that are menus, footers, forms, adverts, comments and
the like by tag, role or class. A page counts as one over the number of pages that have most of the
rest of its article (the median over the article's lines outside the subtree, by length), so copies
of an article, edited or not, count as about one page and are not taken for a template.
"""

from __future__ import annotations

import hashlib
import html as htmllib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.url_cascade import url_host
from sluice.session import cut_lineage

MIN_PAGES = 5  # different pages of a host that a template part is on at least
MIN_SHARE = 0.3  # of the different pages of the host
UNIT = 10**9  # one page; counts are sums of whole numbers, so that they don't depend on row order

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
DROPPED = set(
    "head nav footer aside form script style noscript template iframe svg canvas object button select "
    "textarea menu dialog audio video math title".split()
)
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"}
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "optgroup"}),
}
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
PARTS = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside widget widgets ad ads adv advert "
    "adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup share sharing social related recommended "
    "recommendations footer masthead topbar login pagination pager copyright disclaimer skip toolbar paywall".split()
)
COMMENTS = set("comment comments reply replies disqus respond reviews".split())
WRAPPERS = {"html", "body", "main"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S
)
_UNQUOTED = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_START = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


@dataclass
class Element:
    tag: str
    parent: int
    drop: str = ""  # why the element alone is left out: "tag", "part" or "comment"
    mark: str = ""  # class and id, for the hash
    begin: int = 0  # first item inside
    end: int = 0
    size: int = 0  # characters of text inside
    hash: int = 0
    parts: list = field(default_factory=list)


def _attributes(raw: str) -> dict[str, str]:
    return {
        m[1].lower(): htmllib.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)
    }


def _why_dropped(tag: str, attributes: dict[str, str], inside_article: bool) -> str:
    if tag in DROPPED or tag == "header" and not inside_article:
        return "tag"
    if not attributes or tag in WRAPPERS:
        return ""
    names = {t.lower() for t in _SPLIT.split(f"{attributes.get('class', '')} {attributes.get('id', '')}")}
    if names & COMMENTS:
        return "comment"
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return "part"
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return "part"
    return "part" if names & PARTS else ""


def parse(page: str) -> tuple[list[Element], list]:
    """Elements in order of their start, and items: texts, +i and -i - 1 where element i begins and
    ends. Open paragraphs, list items and cells are closed where HTML closes them.

    Time is linear in the page: open elements are found by their tag, and no part is scanned twice. After
    a tag whose quotes or end never come, quotes protect nothing any more; after the last `>` all is text."""
    elements: list[Element] = [Element("#page", -1)]
    items: list = []
    stack = [0]
    open_at: dict[str, list[int]] = defaultdict(list)  # places in the stack of the open elements of a tag
    blocks: list[int] = []  # and of those of blocks

    def innermost(tags) -> int:
        return max((open_at[t][-1] for t in tags if open_at[t]), default=0)

    def text(t: str) -> None:
        if t:
            items.append(htmllib.unescape(t) if "&" in t else t)
            elements[stack[-1]].parts.append(items[-1])

    def close(depth: int) -> None:
        while len(stack) > depth:
            i = stack.pop()
            e = elements[i]
            if i:
                open_at[e.tag].pop()
                if e.tag in BLOCKS:
                    blocks.pop()
            e.end = len(items)
            joined = " ".join("\0".join(p for p in e.parts if isinstance(p, str)).split())
            inner = [p for p in e.parts if not isinstance(p, str)]
            e.size = len(joined) + sum(elements[p].size for p in inner)
            body = f"{e.tag}\1{e.mark}\1{joined}\1" + ",".join(str(elements[p].hash) for p in inner)
            e.hash = int.from_bytes(hashlib.blake2b(body.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
            e.parts = []
            items.append(-i - 1)
            if stack:
                elements[stack[-1]].parts.append(i)

    at, size, token = 0, len(page), _TOKEN
    while at < size:
        start = _START.search(page, at)
        m = token.match(page, start.start()) if start else None
        if start and not m and token is _TOKEN:
            token = _UNQUOTED
            m = token.match(page, start.start())
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_at[tag]:
                close(open_at[tag][-1])
            continue
        if tag in CLOSES_P:
            depth = innermost(["p"])
            if depth and depth >= (blocks[-1] if blocks else 0):
                close(depth)
        if tag in CLOSED_BY:
            ends, bars = CLOSED_BY[tag]
            while (depth := innermost(ends)) > innermost(bars):
                close(depth)
                if tag not in ("tr", "tbody", "tfoot"):
                    break
        attributes = _attributes(m[3]) if m[3].strip(" /\n\t") else {}
        inside = bool(open_at["article"] or open_at["main"])
        i = len(elements)
        elements.append(
            Element(tag, stack[-1], _why_dropped(tag, attributes, inside), f"{attributes.get('class', '')}#{attributes.get('id', '')}", len(items))
        )
        items.append(i)
        open_at[tag].append(len(stack))
        if tag in BLOCKS:
            blocks.append(len(stack))
        stack.append(i)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS and tag not in RAW:
            close(len(stack) - 1)
        elif tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            close(len(stack) - 1)
            at = end.end() if end else size
    close(0)
    return elements, items


def main_element(elements: list[Element], template: set[int] | frozenset = frozenset()) -> int:
    """The article of most text that is no comment and not inside a dropped element or a subtree of
    `template`; else main, body or the page. Classes of what surrounds an article do not count, but
    for comments, nor does the text of template subtrees."""
    best = {"article": (0, -1), "main": (0, -1), "body": (-1, -1)}
    cut = [0] * len(elements)
    if template:
        for i in range(len(elements) - 1, 0, -1):
            e = elements[i]
            cut[e.parent] += e.size if e.hash in template else cut[i]
    barred = [False] * len(elements)
    for i, e in enumerate(elements):
        up = barred[e.parent] if e.parent >= 0 else False
        barred[i] = up or e.drop in ("tag", "comment") or i > 0 and e.hash in template
        if e.tag in best and not barred[i] and e.drop != "part" and e.size - cut[i] > best[e.tag][0]:
            best[e.tag] = (e.size - cut[i], i)
    return next((i for _, i in best.values() if i >= 0), 0)


def _lines(
    elements: list[Element], items: list, root: int, template: set[int] | frozenset = frozenset()
) -> tuple[list[str], dict[int, tuple[int, int]]]:
    """Texts of the blocks of element `root`, in page order, without subtrees of `template`; and for
    each block element inside that is left in, the lines (from, to) that are its own."""
    out, held, places = [], [], {}

    def flush() -> None:
        line = " ".join("".join(held).split())
        if line:
            out.append(line)
        held.clear()

    at, end = elements[root].begin, elements[root].end
    while at < end:
        item = items[at]
        at += 1
        if isinstance(item, str):
            held.append(item)
            continue
        i = item if item >= 0 else -item - 1
        e = elements[i]
        left_out = item >= 0 and item != root and (e.drop or e.hash in template)
        if left_out:
            at = e.end + 1
        if e.tag in BLOCKS:
            flush()
            if not left_out:
                places[i] = (len(out), len(out)) if item >= 0 else (places[i][0], len(out))
        elif e.tag == "br":
            held.append(" ")
    flush()
    return out, places


def blocks(page: str, template: set[int] | frozenset = frozenset()) -> list[str]:
    """Texts of the blocks of the main element, in page order, without subtrees of `template`."""
    elements, items = parse(page)
    return _lines(elements, items, main_element(elements, template), template)[0]


def skeleton(page: str) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
    """(hash, length) of the lines of the main element, and (hash, from, to) of every block element
    of the page with text, but for those around the main element; `from` to `to` are its lines."""
    elements, items = parse(page)
    root = main_element(elements)
    lines, places = _lines(elements, items, root)
    main = elements[root]
    parts = [
        (e.hash, *places.get(i, (0, 0)))
        for i, e in enumerate(elements)
        if e.tag in BLOCKS and e.size and not (e.begin <= main.begin and e.end >= main.end)
    ]
    digests = (hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=8).digest() for t in lines)
    return [(int.from_bytes(d, "little", signed=True), len(t)) for d, t in zip(digests, lines)], parts


def page_weights(
    lines: list[tuple[int, int]], parts: list[tuple[int, int, int]], shared: dict[int, int]
) -> dict[int | None, int]:
    """For each subtree of a page (None: the page itself), UNIT over the number of pages that have
    most of the article outside it; 0 if nothing is outside. `shared`: pages of the lines that are on
    several."""

    def weight(sizes: dict[int, int]) -> int:
        half, past = sum(sizes.values()) / 2, 0
        for pages in sorted(sizes):
            past += sizes[pages]
            if sizes[pages] and past >= half:
                return round(UNIT / pages)
        return 0

    every: dict[int, int] = {}
    for h, n in lines:
        every[shared.get(h, 1)] = every.get(shared.get(h, 1), 0) + n
    whole = weight(every)
    places: dict[int, set[int]] = {}
    for h, first, last in parts:
        places.setdefault(h, set()).update(range(first, last))
    out: dict[int | None, int] = {None: whole}
    for h, inside in places.items():
        if not inside:
            out[h] = whole
            continue
        rest = dict(every)
        for i in inside:
            rest[shared.get(lines[i][0], 1)] -= lines[i][1]
        out[h] = weight(rest)
    return out


def host_templates(
    pages: DataFrame, url_col: str = "url", html_col: str = "html",
    min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
) -> DataFrame:
    """(host, template): hashes of the subtrees that are on `min_pages` different pages of the host
    and on `min_share` of them, so a list is no longer than a few pages have elements."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [skeleton(page or "") for page in batch.column(1).to_pylist()]
            kinds = [pa.list_(pa.int64())] * 5
            columns = [[[r[k] for r in one[side]] for one in found] for side, k in ((0, 0), (0, 1), (1, 0), (1, 1), (1, 2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns, kinds)],
                names=["host", "lines", "sizes", "parts", "first", "last"],
            )

    numbers = ", ".join(f"{c} array<long>" for c in ("lines", "sizes", "parts", "first", "last"))
    seen = pages.select(url_host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    seen = seen.mapInArrow(cut, f"host string, {numbers}")
    seen = cut_lineage(seen.withColumn("page", F.monotonically_increasing_id()))
    each = seen.select("host", "page", F.explode(F.array_distinct("lines")).alias("line"))
    several = each.groupBy("host", "line").agg(F.count("*").alias("n")).where("n > 1")
    shared = each.join(several, ["host", "line"]).groupBy("page").agg(
        F.collect_list("line").alias("line"), F.collect_list("n").alias("n")
    )
    known = seen.join(shared, "page", "left").select(*seen.columns[:-1], "line", "n")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, parts, weights = [], [], []
            for host, lines, sizes, inner, first, last, line, n in zip(*(c.to_pylist() for c in batch.columns)):
                found = page_weights(list(zip(lines, sizes)), list(zip(inner, first, last)), dict(zip(line or (), n or ())))
                hosts += [host] * len(found)
                parts += found.keys()
                weights += found.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(parts, pa.int64()), pa.array(weights, pa.int64())],
                names=["host", "part", "weight"],
            )

    weighed = known.mapInArrow(count, "host string, part long, weight long")
    # a sum of one over the copies, for every copy: a whole number but for the last digits
    pages_of = F.round(F.sum("weight") / UNIT, 3)
    counted = weighed.groupBy("host", "part").agg(pages_of.alias("n"))
    counted = cut_lineage(counted.where(F.col("part").isNull() | (F.col("n") >= min_pages)))
    total = counted.where(F.col("part").isNull()).select("host", F.col("n").alias("total"))
    often = counted.where(F.col("part").isNotNull()).join(total, "host")
    return often.where(F.col("n") >= F.col("total") * min_share).groupBy("host").agg(
        F.collect_set("part").alias("template")
    )


def main_texts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
) -> DataFrame:
    """(id, url, text, n_chars) for every row of `pages`: blocks joined by a line feed; an empty text
    for null or empty html. Pages without a host are one host. Repeated rows give repeated rows."""
    templates = cut_lineage(host_templates(pages, url_col, html_col, min_pages, min_share))
    names = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = names.withColumn("host", url_host(F.col("url"))).join(templates, "host", "left")
    rows = rows.select("html", "template", "id", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                "\n".join(blocks(page or "", frozenset(template or ())))
                for page, template in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(3), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in names.schema}
    done = rows.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
    return done.withColumnsRenamed({"id": id_col, "url": url_col})
