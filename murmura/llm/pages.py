"""Main text of web pages by tag-path ratios.

Text blocks of a page are grouped by their root-to-leaf tag path. A path's ratio
is its text per node, fused with its punctuation per node: prose has long nodes
with punctuation, menus have many short ones without. Ratios are smoothed over
neighbouring blocks in page order, reduced by the path's share of link text, and
blocks above a part of their standard deviation are content. All blocks of each article that holds some of them (or,
without one, of the deepest element that holds most) are the text too, short
ones included, except what stands in menus, adverts, forms and the like. A form
around most of the page is no such part.

One row per page, nothing moves. Nulls: a null or empty html has an empty text.
Unclosed elements end with their parent, cut-off pages end where they are cut,
pages of any length are parsed whole. Repeated rows are extracted each; an empty
table stays empty; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from murmura.llm.base import query, table
from murmura.llm.bytescan import row_blocks

THRESHOLD = 0.5
HELD_SHARE = 0.8
LINK_SHARE = 0.5

# Fixed values of HTML: elements without content, with raw content, and that start a new block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg")
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
# Start tags that end an open element of these names.
ENDS_OPEN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LISTS = ("ul", "ol", "dl", "table", "select")
CONTENT_NODES = frozenset(["article", "main"])
# Elements that hold a block each, so their parent is the container.
SINGLE_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr tbody blockquote pre caption figcaption summary legend option".split())

# Our own choice: elements, roles and words of class and id that mark what is not the article.
ASIDE_ELEMENTS = frozenset("nav footer aside head button select menu dialog object".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
ASIDE_WORDS = frozenset(
    "ad ads adbox advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies discussion disqus footer "
    "header masthead menu modal nav navbar navigation newsletter notice notices notification popup promo promoted promotion related share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)

# Inside an article these name its own head.
HEADS = frozenset(["header", "masthead"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?=>|\Z)|[^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s/]|$)", re.IGNORECASE)
_VALUE_END = re.compile(r"=\s*[^\s\"'>]+$")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE) for name in RAW}
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？]")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Node:
    name: str
    path: int
    parent: int
    block: int  # the nearest block element, itself included
    aside: bool
    article: bool
    link: bool
    own: bool = False  # marked by itself as an aside, by more than being a form
    soft: bool = False  # marked by a part of a name inside an article: an aside where the block has little text too


@dataclass(slots=True)
class Block:
    node: int
    text: str
    linked: float  # share of link text


def _marks(name: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Is an element an aside, and is it one where its blocks have little text?

    A class or id that is one of the words counts anywhere. Words inside longer
    names count for block elements, in an article only where a block has little text.
    """
    if name in ASIDE_ELEMENTS or (name == "header" and not in_article):
        return True, False
    soft = False
    for key, *values in _ATTRIBUTE.findall(attributes) if "=" in attributes or "hidden" in attributes else ():
        value, key = next((v for v in values if v), ""), key.lower()
        if key in ("class", "id") and name not in ("html", "body"):
            allowed = HEADS if in_article else frozenset()
            if any(w in ASIDE_WORDS and w not in allowed for w in value.lower().split()):
                return True, False
            if name in BLOCK and any(w.lower() in ASIDE_WORDS and w.lower() not in allowed for w in _NAME_PART.findall(value)):
                if not in_article:
                    return True, False
                soft = True
        if (key == "role" and value.lower() in ASIDE_ROLES) or key == "hidden":
            return True, False
    return _HIDDEN.search(attributes) is not None, soft


class _Open:
    """Open elements, with the places of each name, so that closing never searches the stack."""

    def __init__(self) -> None:
        self.stack = [0]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.frames: list[int] = []  # places of block elements other than paragraphs

    def push(self, node: int, name: str) -> None:
        self.places[name].append(len(self.stack))
        if name in BLOCK and name != "p":
            self.frames.append(len(self.stack))
        self.stack.append(node)

    def last(self, names: Iterable[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places[n]), default=0)

    def cut(self, place: int, nodes: list[Node]) -> None:
        while len(self.stack) > place:
            name = nodes[self.stack.pop()].name
            self.places[name].pop()
            if self.frames and self.frames[-1] == len(self.stack):
                self.frames.pop()

    def close(self, names: Iterable[str], barrier: int, nodes: list[Node]) -> None:
        """End the innermost element of ``names``, and all inside it, if it lies within the barrier."""
        place = self.last(names)
        if place > barrier:
            self.cut(place, nodes)


def parse(page: str) -> tuple[list[Node], list[Block]]:
    """Elements of a page, and its text by blocks in page order with white space made one space."""
    nodes = [Node("", 0, -1, 0, False, False, False)]
    paths: dict[tuple[int, str], int] = {}
    blocks: list[Block] = []
    open_, pieces, linked, at = _Open(), [], 0, 0

    def add(text: str) -> None:
        nonlocal linked
        top = nodes[open_.stack[-1]]
        if top.aside and not nodes[top.block].aside:
            pieces.append(" ")  # an aside inside a block's line
            return
        pieces.append(text)
        if top.link:
            linked += len("".join(text.split()))

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        if text:
            blocks.append(Block(nodes[open_.stack[-1]].block, text, min(1.0, linked / max(1, len(text.replace(" ", ""))))))
        pieces.clear()
        linked = 0

    while at < len(page):
        token = _TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if token["close"]:
            if name in BLOCK:
                flush()
            open_.close((name,), 0, nodes)
            continue
        attributes = token["attributes"]
        ended = attributes.endswith("/") and not _VALUE_END.search(attributes)
        if name in RAW:
            if name == "svg" and ended:
                continue
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID:
            if name == "hr":
                flush()
            pieces.append(" ")
            continue
        if name in BLOCK:
            flush()
            open_.close(("p",), open_.frames[-1] if open_.frames else 0, nodes)
            if name in ENDS_OPEN:
                open_.close(ENDS_OPEN[name], open_.last(_LISTS), nodes)
        above = open_.stack[-1]
        parent = nodes[above]
        article = parent.article or name in CONTENT_NODES
        own, soft = _marks(name, attributes, article)
        path = paths.setdefault((parent.path, name), len(paths) + 1)
        block = len(nodes) if name in BLOCK else parent.block
        nodes.append(Node(name, path, above, block, parent.aside or own or name == "form", article, parent.link or name == "a", own, parent.soft or soft))
        if not ended:
            open_.push(len(nodes) - 1, name)
    flush()
    return nodes, blocks


def _smoothed(values: list[float]) -> list[float]:
    """Weighted means over a block and its two neighbours on each side."""
    weights = (0.05, 0.25, 0.4, 0.25, 0.05)
    out = []
    for i in range(len(values)):
        near = [(w, values[i + k - 2]) for k, w in enumerate(weights) if 0 <= i + k - 2 < len(values)]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


def _path(nodes: list[Node], block: Block) -> tuple[int, bool, bool]:
    node = nodes[block.node]
    return node.path, node.aside, node.soft


def _weight(length: float, marks: float) -> float:
    return length * math.log2(2 + marks)


def path_ratios(nodes: list[Node], blocks: list[Block]) -> tuple[list[float], list[float]]:
    """Each block's path ratio (text per node of the path, fused with its punctuation per node), and its path's share of link text."""
    text, marks, count, linked = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(float)
    for b in blocks:
        path = _path(nodes, b)
        text[path] += len(b.text)
        marks[path] += len(_PUNCTUATION.findall(b.text))
        count[path] += 1
        linked[path] += len(b.text) * b.linked
    ratio = {p: 0.0 if p[1] else _weight(text[p] / count[p], marks[p] / count[p]) for p in text}
    shares = [linked[p] / text[p] for p in (_path(nodes, b) for b in blocks)]
    return [ratio[_path(nodes, b)] for b in blocks], shares


def _held(nodes: list[Node], own: dict[int, int]) -> list[int]:
    """Per element the sum over itself and all inside it; parents stand before their children."""
    total = [own.get(n, 0) for n in range(len(nodes))]
    for n in range(len(nodes) - 1, 0, -1):
        total[nodes[n].parent] += total[n]
    return total


def content_nodes(nodes: list[Node], blocks: list[Block], threshold: float = THRESHOLD, held: float = HELD_SHARE) -> tuple[set[int], set[int], set[int]]:
    """The elements whose blocks are content (every article that holds blocks above the threshold, or else the deepest
    element with nearly all of them), and the indices of the blocks above the threshold, and of those that are never text."""
    ratios, shares = path_ratios(nodes, blocks)
    smooth = _smoothed(ratios)
    mean = sum(smooth) / len(smooth)
    limit = threshold * math.sqrt(sum((v - mean) ** 2 for v in smooth) / len(smooth))
    own, accepted, never = defaultdict(int), set(), set()
    for k, (b, value, share) in enumerate(zip(blocks, smooth, shares, strict=True)):
        node = nodes[b.node]
        # Smoothing lifts what stands next to prose; links, and asides by a part of a name, must hold text themselves.
        if node.aside or (node.soft and _weight(len(b.text), len(_PUNCTUATION.findall(b.text))) < mean):
            never.add(k)
        elif share > LINK_SHARE and not node.article:
            never.add(k)
        elif value * (1 - share) >= limit:
            accepted.add(k)
            own[b.node] += len(b.text)
    weight = _held(nodes, own)
    articles = {n for n, node in enumerate(nodes) if node.name in CONTENT_NODES and weight[n]}
    if articles:
        return articles, accepted, never
    return {max((n for n, node in enumerate(nodes) if weight[n] and weight[n] >= held * weight[0] and node.name in BLOCK - SINGLE_BLOCK), default=0)}, accepted, never


def main_text(page: str | None, threshold: float = THRESHOLD, held: float = HELD_SHARE) -> str:
    """The articles' blocks and all others above the threshold, one a line."""
    nodes, blocks = parse(page or "")
    if not blocks:
        return ""
    _open_forms(nodes, blocks)
    chosen, accepted, never = content_nodes(nodes, blocks, threshold, held)
    inside = [False] * len(nodes)
    for n, node in enumerate(nodes):
        inside[n] = n in chosen or (n > 0 and inside[node.parent])
    return "\n".join(b.text for k, b in enumerate(blocks) if k not in never and (k in accepted or inside[b.node]))


def _open_forms(nodes: list[Node], blocks: list[Block]) -> None:
    """A form around most of what is no aside by other marks is the page's frame: its own mark goes."""
    forms = [n for n, node in enumerate(nodes) if node.name == "form" and node.aside]
    if not forms:
        return
    marked = [False] * len(nodes)
    for n, node in enumerate(nodes):
        marked[n] = node.own or (n > 0 and marked[node.parent])
    own = defaultdict(int)
    for b in blocks:
        if not marked[b.node]:
            own[b.node] += len(b.text)
    weight = _held(nodes, own)
    frames = {n for n in forms if 2 * weight[n] > weight[0]}
    for n, node in enumerate(nodes):
        if n and frames:
            node.aside = nodes[node.parent].aside or node.own or (node.name == "form" and n not in frames)


def extracted(pages: DataFrame, threshold: float = THRESHOLD, held: float = HELD_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of pages (page_id, url, html)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_blocks(whole, "html"):
                texts = [main_text(page.as_py(), threshold, held) for page in batch.column("html")]
                columns = [batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(rows, "page_id bigint, url string, text string, n_chars bigint")


@query("op10_html_main_text", None)
def op10_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(table(spark, folder, "pages"))
