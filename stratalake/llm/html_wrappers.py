"""Main text of web pages by wrappers inferred per host.

A wrapper is a union-free regular expression over tokens: elements, text slots, optional parts ``(...)?`` and repeated
parts ``(...)+``, without alternatives. Every page is at first its own wrapper. Two wrappers are aligned token by token:
where texts differ, a slot takes their place; where elements differ, the side whose element turns up again further on
decides, and what was skipped is optional; where an element comes again, all from its first to its second occurrence is
a repeated part, whose several elements are optional in it. So an element stands once in a part, and a wrapper is as long as
the number of distinct ways from the root to an element, however long or many the pages are.

The wrappers of a host's pages (of one layout: with an ``article``, with another marked part, with neither) are aligned
within a batch first, then in rounds of bounded groups, so a host may hold any share of all pages. Slots count the
texts and characters they took on all pages, and the characters inside links. From these each wrapper decides once
which slots hold the article: those in ``article`` elements, else in the marked part of most prose, else in the part
that holds most prose of the parts around it; there, lists of links and texts equal on all pages are left out. Each
page is then read along its wrapper.

Defined results: a null or empty page has an empty text. A url that is null or has no ``://`` belongs to the host "".
Repeated rows are kept, each with its text. Unclosed, wrongly nested and cut off elements are closed where HTML closes
them or at the end of the page; elements nested deeper than 48 are read as part of the one above. No rows give no rows.
Columns beside id, url and html are left alone and may have any name.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, ship_package, stored
from .url_filters import host

# Fixed values of HTML: elements without content, elements whose content is no markup, and blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav noscript ol optgroup option p pre"
    " search section select summary table tbody td template tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Open elements that a start tag closes, unless an element stands between that is no address, div, p or inline element.
CELLS = frozenset("td th tr tbody tfoot".split())
CLOSED_BY = {
    "p": BLOCKS - {"body", "head", "html", "optgroup", "option", "template"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dd", "dt"]),
    "dd": frozenset(["dd", "dt"]),
    "td": CELLS,
    "th": CELLS,
    "tr": CELLS - {"td", "th"},
    "thead": CELLS - {"td", "th", "tr"},
    "tbody": CELLS - {"td", "th", "tr"},
    "option": frozenset(["optgroup", "option"]),
    "head": frozenset(["body"]),
}
THROUGH = frozenset(["address", "div", "p"])
# End tags do not reach beyond these.
SCOPES = frozenset("caption table td template th".split())

# Elements that never hold the article; roles and words of class and id that say the same of any element.
ASIDE_TAGS = frozenset(
    "aside audio button canvas datalist dialog footer form head menu nav noscript object search select svg template"
    " video".split()
)
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices"
    " notification pager pagination paywall popup promo promoted promotion recommendations recommended related replies"
    " reply respond responses search share sharing sidebar signin signup sponsor sponsored subscribe subscription teaser"
    " toc toolbar topbar trending widget widgets".split()
)
# Of these words only such as deny an article or main element are taken from its own class and id.
DENYING_WORDS = frozenset("ad comment comments promo related reply sponsored teaser".split())
MAIN_WORDS = frozenset("article articlebody content entry main post story".split())
DEEPEST = 48
FAN_IN = 64
MAIN_SHARE = 0.6
LEAST_PROSE = 0.5
TEXT = "#"

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>"'=]+|=\s*"[^"]*"|=\s*'[^']*'|=|["'])*+(?:>|\Z)""", re.DOTALL
)
NAME = re.compile(r"[^\s/>]+")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    """An element: its tag, what it is marked as, and its elements and texts (text, whether in a link) in order."""

    __slots__ = ("held", "mark", "tag")

    def __init__(self, tag: str, mark: str = ""):
        self.tag, self.mark, self.held = tag, mark, []

    @property
    def label(self) -> str:
        return f"{self.tag}.{self.mark}" if self.mark else self.tag


def mark_of(tag: str, attributes: str) -> str:
    """``aside``, ``main`` or nothing: what an element's attributes say of it."""
    found = ""
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        said = value.lower()
        if name == "hidden" or name == "role" and said in ASIDE_ROLES:
            return "aside"
        if name == "role" and said in ("article", "main") or name == "itemprop" and said == "articlebody":
            found = "main"
        if name not in ("class", "id") or tag in ("body", "html"):
            continue
        for part in value.split():
            words = [word.lower() for word in WORDS.findall(part)]
            # "has-sidebar" and "content-with-sidebar" speak of something else.
            words = words[: words.index("with")] if "with" in words else words
            if not words or words[0] in ("has", "no", "without"):
                continue
            main = not MAIN_WORDS.isdisjoint(words)
            denied = DENYING_WORDS if tag in ("article", "header", "main") else ASIDE_WORDS
            if not denied.isdisjoint([word for word in words if not (main and word == "header")]):
                return "aside"
            if main:
                found = "main"
    return found


def parse(page: str) -> Element:
    """The page as a tree of blocks and marked parts. Inline elements are read through, empty ones part words."""
    root = Element("")
    path = [root]
    link = 0  # the depth at which a link opened
    too_deep: Counter = Counter()
    at, end = 0, len(page)
    while at < end:
        match = TOKEN.search(page, at)
        stop = match.start() if match else end
        if stop > at:
            path[-1].held.append((page[at:stop], link > 0))
        if match is None:
            break
        token, at = match.group(), match.end()
        if token[1] in "!?":
            continue
        closing = token[1] == "/"
        name = NAME.match(token, 1 + closing)
        tag = name.group().lower()
        if tag == "a":
            link = 0 if closing else len(path)
        elif closing:
            if tag == "p" and all(e.tag != "p" for e in path):
                path[-1].held.append(Element("p"))
            elif tag in VOID:
                path[-1].held.append((" ", False))
            elif too_deep[tag] > 0:
                too_deep[tag] -= 1
            else:
                close(path, tag)
        elif tag in VOID:
            path[-1].held.append((" ", False))
        elif tag in RAW:
            over = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = over.end() if over else end
        else:
            if tag in CLOSERS:
                make_room(path, tag)
            attributes = token[name.end() : -1]
            mark = mark_of(tag, attributes) if attributes else ""
            inside = any(e.tag in ("article", "main") for e in path)
            if tag in ASIDE_TAGS or tag == "header" and not inside:
                mark = "aside"
            # Inside a marked inline element its like are kept too, so that its own end tag is found.
            if tag in BLOCKS or mark == "aside" or any(e.tag == tag and tag not in BLOCKS for e in path):
                element = Element(tag[:20], mark)
                path[-1].held.append(element)
                if token.endswith("/>") and tag not in BLOCKS:
                    continue
                if len(path) < (2 * DEEPEST if mark == "aside" else DEEPEST):
                    path.append(element)
                elif tag not in CLOSED_BY:
                    too_deep[tag] += 1
        if link > len(path):
            link = 0
    return root


CLOSERS = frozenset().union(*CLOSED_BY.values())


def make_room(path: list[Element], tag: str) -> None:
    """Close what a start tag closes."""
    place = len(path) - 1
    while place > 0:
        open_tag = path[place].tag
        if tag in CLOSED_BY.get(open_tag, ()):
            del path[place:]
        elif open_tag in BLOCKS and open_tag not in THROUGH:
            return
        place -= 1


def close(path: list[Element], tag: str) -> None:
    """Close the nearest open element of that tag; an end tag without one is left out."""
    for place in range(len(path) - 1, 0, -1):
        if path[place].tag == tag:
            del path[place:]
            return
        if path[place].tag in SCOPES and tag not in CELLS and tag != "table":
            return


def layout_of(root: Element) -> str:
    """``article``, ``main`` or nothing: the best mark of a part that holds text, outside of all asides."""
    best, todo = "", [root]
    while todo:
        element = todo.pop()
        if element.mark == "aside":
            continue
        if element.tag == "article" and _has_text(element):
            return "article"
        if (element.tag == "main" or element.mark == "main") and not best and _has_text(element):
            best = "main"
        todo += [held for held in element.held if isinstance(held, Element)]
    return best


def _has_text(element: Element) -> bool:
    todo = [element]
    while todo:
        for held in todo.pop().held:
            if isinstance(held, Element):
                if held.mark != "aside":
                    todo.append(held)
            elif not held[0].isspace():
                return True
    return False


# Wrappers. A content is a list of parts; a part is ``[repeated, items]``; an item is ``[label, optional, inner]`` where
# ``inner`` is a content or, for a text slot, ``[texts, characters, characters in links, hash of the text or None]``.


def push(content: list, part: list) -> None:
    """Append a part. If the content has one of its labels, all from there on becomes one repeated part."""
    labels = {item[0] for item in part[1]}
    first = next((i for i, (_, items) in enumerate(content) if any(item[0] in labels for item in items)), None)
    if first is None:
        content.append(part)
        return
    joined: dict[str, list] = {}
    for _, items in [*content[first:], part]:
        for item in items:
            joined[item[0]] = both(joined[item[0]], item) if item[0] in joined else item
    items = list(joined.values())
    if len(items) > 1:
        items = [[label, True, inner] for label, _, inner in items]
    content[first:] = [[True, items]]


def both(a: list, b: list) -> list:
    """One item that matches what either matches."""
    label, optional = a[0], a[1] or b[1]
    if label != TEXT:
        return [label, optional, align(a[2], b[2])]
    (n, chars, linked, text), (m, more, more_linked, other) = a[2], b[2]
    return [label, optional, [n + m, chars + more, linked + more_linked, text if text == other else None]]


def align(a: list, b: list) -> list:
    """One content that matches what either matches."""
    where = [{item[0]: i for i, (_, items) in enumerate(side) for item in items} for side in (a, b)]
    result: list = []
    i = j = 0

    def skip(part: list) -> None:
        push(result, [part[0], [[label, True, inner] for label, _, inner in part[1]]])

    while i < len(a) and j < len(b):
        ahead_b = min((where[1][item[0]] for item in a[i][1] if where[1].get(item[0], -1) >= j), default=None)
        ahead_a = min((where[0][item[0]] for item in b[j][1] if where[0].get(item[0], -1) >= i), default=None)
        if ahead_b == j or ahead_a == i:
            start = len(result)
            push(result, a[i])
            push(result, b[j])
            if len(result) > start and len(result[-1][1]) == 1 and not (a[i][0] or b[j][0]):
                result[-1][0] = False  # the same element on both sides, not twice on one
            i, j = i + 1, j + 1
        elif ahead_b is not None and (ahead_a is None or ahead_b - j <= ahead_a - i):
            skip(b[j])
            j += 1
        elif ahead_a is not None:
            skip(a[i])
            i += 1
        else:
            skip(a[i])
            skip(b[j])
            i, j = i + 1, j + 1
    for part in [*a[i:], *b[j:]]:
        skip(part)
    return result


def wrapper_of(element: Element) -> list:
    """The content that matches an element's own tokens."""
    content: list = []
    texts: list[tuple[str, bool]] = []

    def flush() -> None:
        text = " ".join("".join(piece for piece, _ in texts).split())
        if text:
            linked = sum(len(" ".join(piece.split())) for piece, in_link in texts if in_link)
            push(content, [False, [[TEXT, False, [1, len(text), min(linked, len(text)), crc32(text.encode())]]]])
        texts.clear()

    for held in element.held:
        if isinstance(held, Element):
            flush()
            push(content, [False, [[held.label, False, wrapper_of(held)]]])
        else:
            texts.append(held)
    flush()
    return content


def written(content: list) -> str:
    """A wrapper as text, for people."""
    parts = []
    for repeated, items in content:
        inner = []
        for label, optional, held in items:
            one = label if label == TEXT and held[3] is None else f"'{held[3]:08x}'" if label == TEXT else f"<{label}>{written(held)}</>"
            inner.append(f"({one})?" if optional else one)
        parts.append(f"({''.join(inner)})+" if repeated else "".join(inner))
    return "".join(parts)


def _sums(content: list) -> tuple[int, int]:
    """Characters outside links and all characters of a content, without its asides."""
    prose = every = 0
    for _, items in content:
        for label, _, inner in items:
            if label == TEXT:
                prose, every = prose + inner[1] - inner[2], every + inner[1]
            elif not label.endswith(".aside"):
                p, e = _sums(inner)
                prose, every = prose + p, every + e
    return prose, every


def _children(content: list) -> Iterator[list]:
    for _, items in content:
        for item in items:
            if not item[0].endswith(".aside"):
                yield item


def _all_slots(content: list, in_header: bool = False) -> dict:
    """All slots of a content but those in asides; of a header only headings."""
    kept: dict = {}
    for label, _, inner in _children(content):
        tag = label.split(".")[0]
        if label == TEXT:
            if not in_header:
                kept[TEXT] = 1
        else:
            found = _all_slots(inner, (in_header or tag == "header") and tag not in HEADINGS)
            if found:
                kept[label] = found
    return kept


def _prose_slots(content: list, fixed_too: bool) -> dict:
    """The slots of a content without lists of links; without fixed texts unless ``fixed_too``."""
    kept: dict = {}
    for label, _, inner in _children(content):
        if label == TEXT:
            if fixed_too or inner[3] is None or inner[0] < 3:
                kept[TEXT] = 1
            continue
        prose, every = _sums(inner)
        if prose > LEAST_PROSE * every:
            found = _prose_slots(inner, fixed_too)
            if found:
                kept[label] = found
    return kept


def _varying(content: list) -> int:
    """Characters outside links in slots that differ between pages."""
    return sum(
        (inner[1] - inner[2] if inner[3] is None else 0) if label == TEXT else _varying(inner)
        for label, _, inner in _children(content)
    )


def article_slots(content: list, layout: str) -> dict:
    """The slots of a wrapper that hold the article, as nested labels."""
    if layout == "article":
        kept = {}
        for label, _, inner in _children(content):
            if label != TEXT:
                found = _all_slots(inner) if label.split(".")[0] == "article" else article_slots(inner, layout)
                if found:
                    kept[label] = found
        return kept
    if layout == "main":
        ways = list(_marked(content, ()))
        way, inner = max(ways, key=lambda found: (_sums(found[1])[0], found[0]))
        # A marked part inside that holds most of it is meant more closely.
        while deeper := [f for f in _marked(inner, way) if _sums(f[1])[0] >= MAIN_SHARE * max(1, _sums(inner)[0])]:
            way, inner = max(deeper, key=lambda found: (_sums(found[1])[0], found[0]))
        return _under(way, _all_slots(inner))
    # Without marks: down to the part of most prose. Headings on the way belong to it.
    holders = [item for item in _children(content) if item[0] != TEXT and item[0].split(".")[0] not in HEADINGS | {"p", "li", "pre"}]
    prose = _sums(content)[0]
    for label, _, inner in holders:
        if prose and _sums(inner)[0] >= MAIN_SHARE * prose:
            found = article_slots(inner, layout)
            kept = {label: found} if found else {}
            for other, _, held in _children(content):
                if other.split(".")[0] == "h1":
                    kept[other] = _all_slots(held)
            return kept
    mostly_varying = _varying(content) >= MAIN_SHARE * max(1, prose)
    return _prose_slots(content, fixed_too=not mostly_varying)


def _marked(content: list, way: tuple) -> Iterator[tuple[tuple, list]]:
    """The outermost marked parts, with the labels on the way to them."""
    for label, _, inner in _children(content):
        if label == TEXT:
            continue
        if label.endswith(".main") or label == "main":
            yield (*way, label), inner
        else:
            yield from _marked(inner, (*way, label))


def _under(way: tuple, kept: dict) -> dict:
    for label in reversed(way):
        kept = {label: kept}
    return kept


def read_along(element: Element, kept: dict, blocks: list[str]) -> None:
    """Append the blocks of text that an element holds in the kept slots."""
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    for held in element.held:
        if not isinstance(held, Element):
            if TEXT in kept:
                line.append(html.unescape(held[0]))
            continue
        if held.tag in BLOCKS:
            flush()
        if held.label in kept:
            read_along(held, kept[held.label], blocks)
    flush()


# Spark jobs.


def _batch_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(site, layout, wrapper, pages)``: the wrapper of each site and layout in each batch."""
    for batch in batches:
        found: dict[tuple[str, str], list] = {}
        for site, page in zip(batch.column("site").to_pylist(), batch.column("html").to_pylist()):
            root = parse(page or "")
            key, own = (site, layout_of(root)), wrapper_of(root)
            if key in found:
                found[key] = [align(found[key][0], own), found[key][1] + 1]
            else:
                found[key] = [own, 1]
        yield pa.RecordBatch.from_pydict(
            {
                "site": [site for site, _ in found],
                "layout": [layout for _, layout in found],
                "wrapper": [json.dumps(content) for content, _ in found.values()],
                "pages": [pages for _, pages in found.values()],
            },
            schema=pa.schema([("site", pa.string()), ("layout", pa.string()), ("wrapper", pa.string()), ("pages", pa.int64())]),
        )


def _aligned(rows: pd.DataFrame) -> pd.DataFrame:
    content = json.loads(rows["wrapper"].iloc[0])
    for other in rows["wrapper"].iloc[1:]:
        content = align(content, json.loads(other))
    return rows.head(1).assign(wrapper=json.dumps(content), pages=rows["pages"].sum())[["site", "layout", "wrapper", "pages"]]


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(site, layout, wrapper, pages)``: one wrapper per host and layout, as JSON, and its number of pages."""
    schema = "site string, layout string, wrapper string, pages long"
    rows = pages.select(host(F.col(url_col)).alias("site"), F.col(html_col).alias("html"))
    found = stored(map_batches(rows, _batch_wrappers, schema), "wrappers")
    while True:
        most = found.groupBy("site", "layout").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return found
        ship_package(pages.sparkSession)
        groups = -(-most // FAN_IN)
        dealt = found.withColumn("deal", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
        found = stored(dealt.groupBy("site", "layout", "deal").applyInPandas(_aligned, schema), "wrappers")


def _batch_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pydict()
        kept = [json.dumps(article_slots(json.loads(w), layout)) for w, layout in zip(rows["wrapper"], rows["layout"])]
        yield pa.RecordBatch.from_pydict({"site": rows["site"], "layout": rows["layout"], "kept": kept})


@lru_cache(4096)
def _rules(text: str) -> dict:
    return json.loads(text)


def _batch_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, rules in zip(batch.column("html").to_pylist(), batch.column("rules").to_pylist()):
            root, blocks = parse(page or ""), []
            kept = dict(rules or []).get(layout_of(root))
            if kept is not None:
                read_along(root, _rules(kept), blocks)
            texts.append("\n".join(blocks))
        columns = [batch.column("page"), batch.column("url"), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["page", "url", "text"])


def extract(
    pages: DataFrame, found: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``(id, url, text)`` per page: its blocks in the slots its wrapper of ``found`` names, one to a line."""
    kept = map_batches(found.select("site", "layout", "wrapper"), _batch_rules, "site string, layout string, kept string")
    # Three layouts a host at most.
    rules = stored(kept.groupBy("site").agg(F.sort_array(F.collect_list(F.struct("layout", "kept"))).alias("pairs")), "rules")
    rules = rules.select("site", F.map_from_entries("pairs").alias("rules"))
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    joined = rows.withColumn("site", host(F.col("url"))).join(rules, "site", "left").select("page", "url", "html", "rules")
    kind = pages.schema[id_col].dataType.simpleString()
    texts = map_batches(joined, _batch_texts, f"page {kind}, url string, text string")
    return texts.select(F.col("page").alias(id_col), F.col("url").alias(url_col), "text")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text)``: wrappers inferred from all pages, then every page read along its own."""
    return extract(pages, wrappers(pages, url_col, html_col), id_col, url_col, html_col)
