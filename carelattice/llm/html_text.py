"""Main text of web pages by tag-path ratios.

A page is read in one pass into blocks of text, each with its root-to-leaf path of tags and class names. For every path
the text outside of links and the punctuation marks of its blocks are summed. A path's ratio is its text over the root of
its number of blocks (between the sum, which favours long lists of short blocks, and the mean, which favours a single long
one), times one plus its marks a block; ratios are smoothed over the order in which paths occur. Paths whose ratio is at
least SHARE of the largest one are content. What markup tells only weighs: ratios of parts named as menus, adverts, forms,
comments and the like (by tag, role, class or id), and of text outside of an article or main element, if there is one,
count PRIOR, which is more than SHARE, so that no name alone leaves out a path; text of an article counts as TOLD
characters more than it has, which matters on pages that have little more, and an article's best path is content
beside whatever outweighs it. The parents of unnamed content paths are the
content nodes, and a page's text is its content paths with what else stands below a content node: all unnamed blocks, or,
where the node is the body, its own headings and paragraphs. Scripts, styles and hidden parts are no text.

Defined results: null or empty html and pages without text give the empty string. Tags may be left open or be closed in
the wrong order; elements nested deeper than DEPTH belong to the element at that depth, with their text. Rows with equal
ids are read each for itself; nothing depends on other rows. Time grows with the length of a page, whatever its tags.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Share of the largest ratio of the page that a content path needs.
SHARE = 0.45
#: What ratios count in parts that are named as no text, and outside of the page's articles.
PRIOR = 0.5
#: Characters that being an article is worth.
TOLD = 1000
#: Share of link text from which a block outside of articles is a menu.
LINKS = 0.6
#: Deepest nesting of elements.
DEPTH = 256

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)/?>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、؟]")
_WORD = re.compile(r"[a-z]+")

# Names of HTML elements and of usual page parts.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math object select xmp".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
_LEFT_OUT = frozenset("nav footer aside form head button dialog menu fieldset".split())
_PARTS = frozenset("ad ads advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion related replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_WIDE = frozenset({"", "html", "body"})
#: Blocks that belong to the text around them even where that stands in the body itself.
_FLOW = _HEADINGS | frozenset("p li dt dd pre blockquote td th figcaption caption".split())
#: Start tags that end an open element of one of these names, up to an element of the second set.
_ENDS = {
    **{t: (frozenset({"p"}), frozenset("button table td th caption object article section div".split())) for t in _BLOCK},
    "li": (frozenset({"li"}), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset({"dl"})),
    "dd": (frozenset("dt dd".split()), frozenset({"dl"})),
    "tr": (frozenset("tr td th".split()), frozenset({"table"})),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
}


class Node(NamedTuple):
    tag: str
    number: int
    hidden: bool
    named: bool
    article: bool
    link: bool
    header: bool
    path: str


class Block(NamedTuple):
    text: str
    path: str
    tag: str
    home: int
    parents: tuple[int, ...]
    article: bool
    named: bool
    links: int


def _attributes(text: str) -> tuple[str, bool, bool]:
    """Class, whether attributes name a part that is no text, and whether they hide it."""
    names, named, hidden, label = [], False, False, ""
    for name, *values in _ATTRIBUTE.findall(text):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name in ("class", "id"):
            names += value.split()
            label = label or value.split(" ")[0]
        elif name == "role":
            named |= value in _ROLES
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        else:
            hidden |= value in ("", "true", "hidden")
    return label, named or any(not _PARTS.isdisjoint(_WORD.findall(n)) for n in names), hidden


def blocks(page: str) -> list[Block]:
    """The blocks of a page in its order, without those that are never text."""
    found: list[Block] = []
    root = Node("", 0, False, False, False, False, False, "")
    stack, number, deeper = [root], 0, 0
    held: tuple[list[str], list[str]] = ([], [])  # text of the block, and of named parts within it
    links = [0, 0]

    def add(text: str) -> None:
        top = stack[-1]
        if text and not top.hidden:
            held[top.named].append(text)
            if top.link:
                links[top.named] += len(text.strip())

    def flush() -> None:
        for named, parts in enumerate(held):
            if not parts:
                continue
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            top = stack[-1]
            if text and not (top.header and not any(n.tag in _HEADINGS for n in stack)):
                at = max((i for i, n in enumerate(stack) if n.tag in _BLOCK), default=0)
                above = stack[:at]
                found.append(Block(text, stack[at].path, stack[at].tag, above[-1].number if above else -1, tuple(n.number for n in above if n.tag not in _WIDE), top.article, bool(named), links[named]))
        links[:] = 0, 0

    def close(names: frozenset[str] | set[str], bounds: frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                if any(n.tag in _BLOCK for n in stack[i:]):
                    flush()
                del stack[i:]
                return
            if stack[i].tag in bounds:
                return

    at, last = 0, page.rfind(">") + 1  # no tag ends beyond
    while m := _TAG.search(page, at, last):
        add(page[at : m.start()])
        at = m.end()
        ends, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            if m[0].startswith("<![CDATA["):
                at = at if m[0].endswith("]]>") else len(page)
                add(html.escape(page[m.start() + 9 : at].removesuffix("]]>"), quote=False))
            elif m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(page)
            continue
        tag = tag.lower()
        if ends:
            if tag in _BLOCK:
                flush()
            if deeper:
                deeper -= 1
            else:
                close({tag}, frozenset() if tag in _BLOCK else _BLOCK)
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at, last) if not m[0].endswith("/>") else None
            at = end.end() if end else at if m[0].endswith("/>") else len(page)
            continue
        if tag in _BLOCK:
            flush()
            if not deeper:
                close(*_ENDS[tag])
                if tag in _HEADINGS:
                    close(_HEADINGS, _BLOCK - _HEADINGS)
        if tag in _VOID:
            add(" ")
            continue
        if len(stack) >= DEPTH:
            deeper += 1
            continue
        top, number = stack[-1], number + 1
        label, named, hidden = _attributes(rest) if rest and not rest.isspace() else ("", False, False)
        if tag in ("body", "html", "article", "main"):
            named = hidden = False
        article = top.article or tag in ("article", "main")
        named = top.named or named or tag in _LEFT_OUT or tag == "header" and not article
        stack.append(Node(tag, number, top.hidden or hidden, named, article, top.link or tag == "a", top.header or tag == "header", f"{top.path}/{tag}" + (f".{label}" if label else "")))
    # a "<" that begins no tag is text; a comment may be left open
    add(page[at:].partition("<!--")[0])
    flush()
    return found


def tag_path_ratios(found: list[Block]) -> dict[tuple, float]:
    """Fused, smoothed ratio of every path (named parts and text in articles apart), in the order of first occurrence."""
    sums: dict[tuple, list[float]] = {}
    for b in found:
        s = sums.setdefault((b.path, b.named, b.article), [0.0, 0.0, 0.0])
        s[0] += max(0, len(b.text) - b.links)
        s[1] += len(_PUNCTUATION.findall(b.text))
        s[2] += 1
    v = [length / math.sqrt(n) * (1 + marks / n) + (TOLD if article and not named else 0) for (_, named, article), (length, marks, n) in sums.items()]
    smooth = [(v[max(i - 1, 0)] + 6 * v[i] + v[min(i + 1, len(v) - 1)]) / 8 for i in range(len(v))]
    return dict(zip(sums, smooth, strict=True))


def main_text(page: str | None) -> str:
    """The text of a page's content nodes: its blocks, one to a line."""
    found = blocks(page or "")
    if not found:
        return ""
    ratios = tag_path_ratios(found)
    articles = any(b.article and not b.named for b in found)
    prior = [PRIOR if b.named or articles and not b.article else 1 for b in found]
    scores = [ratios[b.path, b.named, b.article] * w for b, w in zip(found, prior, strict=True)]
    limit = min(SHARE * max(scores), max((s for b, s in zip(found, scores, strict=True) if b.article and not b.named), default=math.inf))
    nodes = {b.home for b, s, w in zip(found, scores, prior, strict=True) if s >= limit and w == 1}

    def kept(b: Block, score: float, weight: float) -> bool:
        if b.links >= LINKS * len(b.text) and not b.article:
            return False
        if score >= limit:
            return True
        return weight == 1 and (not nodes.isdisjoint(b.parents) or b.home in nodes and b.tag in _FLOW)

    return "\n".join(b.text for b, s, w in zip(found, scores, prior, strict=True) if kept(b, s, w))


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """pages with the column out_col (replaced if there) that holds the main text of html_col; one pass, no shuffle."""
    keep = [c for c in pages.columns if c not in (html_col, out_col)]
    source = pages.select(*keep, F.col(html_col).alias(html_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html_col):
            text = pa.array([main_text(x) for x in batch.column(html_col).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), text], names=[*keep, out_col])

    schema = source.select(*keep, F.col(html_col).cast("string").alias(out_col)).schema
    return source.mapInArrow(run, schema)
