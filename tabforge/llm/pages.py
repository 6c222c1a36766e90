"""Main text of web pages by a minimum cut.

A page is read into blocks of text, each with its place in the element tree. A linear classifier
over what a block is and stands in gives it an evidence. A class name such as "sidebar" or "comments"
is evidence of bounded weight, for what stands below it up to the next article; where the
element holds most of the page's running text it is none, as names there tell the state of a page
("comments-open", "sidebar-right") and not what a part is. The evidence becomes the capacity of an
edge to the source (main text) or to the sink (the rest). Blocks next to each other, and next
blocks of one parent, are joined by smoothness edges, stronger the more ancestors they share. The
minimum cut, found by maximum flow, is the labelling of least total cost: a block goes with its
neighbours unless its own evidence outweighs them.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabforge.llm.tables import text_of

# Names in pages. Elements that end a block, that are never text, that stand for parts of a page.
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_RAW = frozenset("script style textarea title xmp noembed noframes".split())
_CODE = frozenset("script style".split())  # without an end tag all that follows is code
_ASIDE = frozenset("noscript template svg iframe object canvas audio video select button".split())  # never main text, but elements like others
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_REST = frozenset("nav footer aside form menu dialog head search".split())
_MAIN = frozenset("article main".split())
_REST_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice popup modal overlay newsletter "
    "subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead toolbar share sharing social related recommended "
    "comment comments respond reply replies disqus widget login signup pagination pager legal copyright disclaimer skip".split()
)
_COMMENT_NAMES = frozenset("comment comments respond reply replies disqus".split())
_ABOUT_OTHERS = frozenset("has with no without".split())  # "has-sidebar" names what stands beside
_MAIN_NAMES = frozenset("article content entry post story main body text".split())
_REST_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_CLOSED_BY = {  # start tags that end an open element of these names
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
}

# Weights of the classifier and of the smoothness edges.
IN_REST = -8.0
NAMED_REST = -6.0
IN_MAIN = 4.0
NAMED_MAIN = 1.0
KIND = {"p": 1.0, "h1": 1.0, "h2": 0.5, "h3": 0.5, "blockquote": 1.0, "pre": 1.0, "figcaption": 0.0, "li": -0.5, "td": -0.5, "dd": 0.0}
LINKED = -4.0
LENGTH = 1.5
SENTENCE = 0.5
NEXT = 0.4
LONG = 80  # characters of a block that is running text
ELSEWHERE = 0.15  # share of an element's running text that articles elsewhere may hold for its names not to count
SHARED = 0.6

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>|<[!?/][^>]*>""", re.S
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Za-z]+")


@dataclass
class _Element:
    tag: str
    parent: _Element | None
    depth: int
    evidence: float  # of the place, from the root down
    rest: bool
    main: bool
    named: _Element | None = None  # the nearest element with a name of boilerplate, unless an article stands between
    comments: bool = False  # whether its own names tell of comments
    running: int = 0  # characters of running text below it


@dataclass
class _Blocks:
    """Blocks in page order: element, text, characters of text and of links."""

    elements: list[_Element] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    linked: list[float] = field(default_factory=list)


def _opened(tag: str, attributes: str, parent: _Element) -> _Element:
    rest, main, evidence = parent.rest, parent.main, 0.0
    names: list[str] = []
    role = ""
    for m in _NAMES.finditer(attributes) if attributes else ():
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            role = value.strip()
        else:
            names += _PARTS.findall(value)
    bad = _REST_NAMES.intersection(names) if tag not in ("body", "html") and _ABOUT_OTHERS.isdisjoint(names) else ()
    is_main = tag in _MAIN or role in ("main", "article")
    if tag in _REST - {"form"} or (tag == "header" and not parent.main) or role in _REST_ROLES:
        rest = True
    if not _MAIN_NAMES.isdisjoint(names):
        evidence = NAMED_MAIN
    out = _Element(tag, parent, parent.depth + 1, min(parent.evidence + evidence, 2 * NAMED_MAIN), rest, main or is_main)
    out.named = out if bad or tag == "form" else None if is_main else parent.named
    out.comments = not is_main and not _COMMENT_NAMES.isdisjoint(bad)
    return out


def _running(blocks: _Blocks) -> set[int]:
    """Elements whose names do not count, by identity: those that hold most of the page's running text.

    Running text is that of long blocks without links, or of all without links if none is long. Where so much text of an
    article stands elsewhere that the element may well be something else, its names count.
    """
    sizes = [len(t) if linked < 0.5 and not e.rest else 0 for e, t, linked in zip(blocks.elements, blocks.texts, blocks.linked)]
    every = sizes
    if any(n >= LONG for n in sizes):
        sizes = [n if n >= LONG else 0 for n in sizes]
    named: dict[int, _Element] = {}
    main = 0  # text of articles without links
    within: Counter = Counter()
    for element, n, all_of_it in zip(blocks.elements, sizes, every):
        of_article = all_of_it if element.main or element.evidence > 0 else 0
        main += of_article
        e: _Element | None = element
        while e is not None and all_of_it:
            e.running += n
            if e.named is e:
                named[id(e)] = e
                within[id(e)] += of_article
            e = e.parent
    out = set()
    for key, e in named.items():
        outside = main - within[key]
        if 2 * e.running >= sum(sizes) and outside <= (0 if e.comments else ELSEWHERE * e.running):
            out.add(key)
    return out


def _scanned(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, value, attributes) of texts, starts and ends of elements; contents of raw elements are left out."""
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            yield "text", page[at:], ""
            return
        if m.start() > at:
            yield "text", page[at : m.start()], ""
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            yield "end", tag, ""
            continue
        attributes = m[3] or m[6] or ""
        if tag in _RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            if close or tag in _CODE:
                at = close.end() if close else n
            continue
        yield "start", tag, attributes


@dataclass
class _Level:
    """An open block element, and the aside elements that are open right in it."""

    tag: str
    asides: list[tuple[str, int]] = field(default_factory=list)
    open: Counter = field(default_factory=Counter)


def _closed_asides(tokens: list[tuple[str, str, str]]) -> dict[int, int]:
    """Start and end of the aside elements that their own end tag closes, in the block they stand in.

    One around an article was meant to end before it, except for a template.
    """
    levels, blocks, closed, main = [_Level("")], Counter(), {}, -1
    for i, (kind, tag, attributes) in enumerate(tokens):
        top = levels[-1]
        if tag in _ASIDE and kind == "start" and not attributes.endswith("/"):
            top.asides.append((tag, i))
            top.open[tag] += 1
        elif tag in _ASIDE and kind == "end" and top.open[tag]:
            while True:
                name, start = top.asides.pop()
                top.open[name] -= 1
                if name == tag:
                    break
            if tag == "template" or main < start:
                closed[start] = i
        elif tag not in _BLOCK or tag in _VOID:
            continue
        elif kind == "start":
            main = i if tag in _MAIN else main
            while not levels[-1].asides and levels[-1].tag in ("p", *_CLOSED_BY.get(tag, ())):
                blocks[levels.pop().tag] -= 1
            levels.append(_Level(tag))
            blocks[tag] += 1
        elif kind == "end" and blocks[tag]:
            while True:
                name = levels.pop().tag
                blocks[name] -= 1
                if name == tag:
                    break
    return closed


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """Texts, starts and ends without closed aside elements; one that is not closed is of the kind "aside"."""
    tokens = list(_scanned(page))
    closed = _closed_asides(tokens) if any(value in _ASIDE for kind, value, _ in tokens if kind == "start") else {}
    i = 0
    while i < len(tokens):
        kind, value, attributes = tokens[i]
        if kind == "text" or value not in _ASIDE:
            yield tokens[i]
        elif kind == "start" and i not in closed and not attributes.endswith("/"):
            yield "aside", value, attributes
        i = closed.get(i, i) + 1


def read_blocks(page: str) -> _Blocks:
    out = _Blocks()
    root = now = _Element("", None, 0, 0.0, False, False)
    pieces: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.elements.append(now)
                out.texts.append(text)
                out.linked.append(min(1.0, linked / len(text)))
            pieces.clear()
        linked = 0

    for kind, value, attributes in _tokens(page):
        if kind == "text":
            pieces.append(value)
            if links:
                linked += len(value.strip())
        elif kind == "aside":  # up to the next start or end of a block
            flush()
            now = _Element(value, now, now.depth + 1, now.evidence, True, now.main)
        elif value == "br":
            pieces.append(" ")
        elif value == "a":
            links = 1 if kind == "start" else 0
        elif value not in _BLOCK:
            continue
        elif kind == "start":
            flush()
            while now.tag in _ASIDE:
                now = now.parent
            closing = _CLOSED_BY.get(value, ())
            e = now
            while e.tag in closing or e.tag == "p":  # a block element ends an open paragraph
                e = e.parent
                now = e
            if value not in _VOID:
                now = _opened(value, attributes, now)
        else:
            flush()
            while now.tag in _ASIDE:
                now = now.parent
            e = now
            while e is not root and e.tag != value:
                e = e.parent
            if e is not root:
                now = e.parent
    flush()
    return out


def evidence(element: _Element, text: str, linked: float, running: set[int]) -> float:
    """Over 0: main text. The place in the page weighs most, then links, length and kind of the block.

    ``running`` are the elements whose names do not count.
    """
    words = text.count(" ") + 1
    score = element.evidence + LENGTH * max(-1.0, min(1.0, (words - 8) / 10)) + KIND.get(element.tag, 0.0) + LINKED * max(0.0, linked - 0.3)
    if text[-1] in ".!?…。！？\"”":
        score += SENTENCE
    if element.main:
        score += IN_MAIN
    if element.rest:
        return score + IN_REST
    named = element.named
    while named is not None and id(named) in running:
        named = named.parent.named if named.parent is not None else None
    return score if named is None else score + NAMED_REST - (IN_MAIN if element.main else 0.0)


def _shared(a: _Element, b: _Element) -> float:
    """Share of the ancestors that two elements have in common."""
    most = max(a.depth, b.depth, 1)
    while a.depth > b.depth:
        a = a.parent
    while b.depth > a.depth:
        b = b.parent
    while a is not b:
        a, b = a.parent, b.parent
    return a.depth / most


def minimum_cut(terminal: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source side. ``terminal``: capacity from the source if over 0,
    to the sink if under; ``edges``: (node, node, capacity both ways). Augmenting flow by levels."""
    n = len(terminal)
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def link(a: int, b: int, there: float, back: float) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(there)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    source, sink = n, n + 1
    for i, c in enumerate(terminal):
        if c > 0:
            link(source, i, c, 0.0)
        elif c < 0:
            link(i, sink, -c, 0.0)
    for a, b, c in edges:
        link(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        following = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[cut] ^ 1]
                del path[cut:]
            while following[a] < len(head[a]):
                e = head[a][following[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                following[a] += 1
            else:
                if a == source:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]
                continue
            path.append(e)
            a = to[e]


def main_text(page: str) -> tuple[str, int, int]:
    """Main text, number of blocks, number kept."""
    blocks = read_blocks(page)
    running = _running(blocks)
    scores = [evidence(*b, running) for b in zip(blocks.elements, blocks.texts, blocks.linked)]
    if all(s > 0 for s in scores) or all(s <= 0 for s in scores):
        kept = [s > 0 for s in scores]
    else:
        edges = []
        last: dict[int, int] = {}
        for i, element in enumerate(blocks.elements):
            if i:
                edges.append((i - 1, i, NEXT + SHARED * _shared(blocks.elements[i - 1], element)))
            before = last.get(id(element.parent))
            if before is not None and before < i - 1:
                edges.append((before, i, SHARED * element.depth / (element.depth + 1)))
            last[id(element.parent)] = i
        kept = minimum_cut(scores, edges)
    lines = [t for t, k in zip(blocks.texts, kept) if k]
    return "\n".join(lines), len(scores), len(lines)


def extract(df: DataFrame, html_col: str = "html") -> DataFrame:
    """``df`` with ``main``: struct of text, n_blocks and n_kept.

    A block's character references are decoded and its white space, of Unicode and in ``pre`` too, made one space; blocks stand
    in page order, one a line. Null and empty pages, and pages without main text, have an empty
    text. Every page is read by itself and whole; other columns stay, one named ``main`` is replaced.
    """

    @F.arrow_udf("struct<text:string,n_blocks:int,n_kept:int>")
    def read(pages: pa.Array) -> pa.Array:
        rows = [main_text(p.as_py() or "") for p in pages]
        texts, n, kept = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(n, pa.int32()), pa.array(kept, pa.int32())], ["text", "n_blocks", "n_kept"])

    return df.withColumn("main", read(text_of(html_col)))
