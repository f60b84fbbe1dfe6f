"""Main text of a page by composite text density.

Every element gets a density: its characters per tag, adjusted by its links

    density = C / T * log_{ln(C * L / max(1, C - L) + LB / CB * C + e)} (C / L * T / LT)

with C its characters, T its tags, L and LT those inside links (each at least 1)
and CB, LB the page's; the logarithm's base is at least 2, so that a part without
links isn't lifted without bound. An element's sum is that of its children's densities. The
element with the largest sum is the core; the smallest density on the path from
the body to the core is the threshold. Every element at or above the threshold
gives its subtree of the largest sum, and the text of these subtrees is the
result (Sun, Song and Liao, 2011).

Scripts, styles, navigation, page headers and footers and asides aren't part of the
tree, unless they hold the page's only ``article`` or ``main``. A class, id or role
that names a menu, sidebar, notice, advert or comments, alone or as a box of them ("comment-list",
"cookie-bar"; "has-sidebar" names none), ``hidden`` and being a form are evidence, not a verdict: they lower an
element's sums and those below it to a fifth. What the core lies in is the article,
whatever its name; the other named parts are then left out, of the densities too. A
paragraph or heading is named only if all of its class is ("social history" isn't).

An element below the body most of whose text is selected (four fifths; half of an
``article`` or ``main``), the rest not being mostly links, counts as a whole, so that
headings and short blocks of an article stay.

Tags need not be balanced: a paragraph, list item or table cell ends where the
next one starts, an end tag closes what is open inside, stray end tags are
ignored. A tag whose quotes don't close ends at its first ">". What an end or a start closes is kept
at hand on every node, so that a page takes time in proportion to its length, however deep. Text inside a block is white-space collapsed and trimmed; blocks are
joined in page order by one newline; nothing else is dropped. A page without any
text, an empty page and null give an empty text. Repeated rows give a row each, an empty table none; other
columns play no part.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces_of, table

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][^\s/<>]*)([^<>]*)>", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.S)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; it is skipped.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg".split())
#: Elements that are never part of an article.
SKIP = RAW | frozenset("head nav footer aside form button select option dialog menu canvas object applet video audio fieldset label input".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
#: What an element's start ends, up to the nearest of the limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "thead": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
}
_LEAST_BASE = 2.0
#: Classes, ids and roles that name a part outside the article: a listed word, alone or with other listed words and such as only say what kind of box it is.
_WORDS = r"(?:ads?|advert[a-z]*|adsense|sponsor[a-z]*|promo[a-z]*|cookies?|consent|gdpr|notices?|notifications?|alerts?|disclaimer|privacy|popup|modal|overlay|newsletter|subscri[a-z]*|signup|sidebar|aside|menu[a-z]*|nav[a-z]*|breadcrumbs?|toolbar|footer|foot|comments?|commentlist|disqus|replies|reply|respond|related|recommend[a-z]*|share|sharing|social|widget|pagination|pager|skip|login|search|complementary|contentinfo|navigation)"
_BOXES = r"(?:lists?|areas?|banners?|bars?|slots?|box(?:es)?|containers?|wrap(?:per)?s?|blocks?|sections?|links?|posts?|articles|stories|buttons?|btns?|icons?|panels?|inner|outer|threads?|items?|units?|groups?|rows?|cols?|column|zones?|tray|strip|top|bottom|left|right|main|site|page|global|primary|secondary|header|heading|title|form|count|messages?|wall|prompt|dialog|ul|nav|[0-9]+)"
_NAMED = re.compile(rf"(?:^|\s)(?:{_BOXES}[_-]+)*{_WORDS}(?:[_-]+(?:{_WORDS}|{_BOXES}))*(?=\s|$)", re.I)
#: Elements of running text: named only if all their tokens are.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre code q cite em strong b i u sub sup mark dfn abbr span".split())
#: The same, but only outside ``article`` and ``main``: inside, they hold the article's heading.
_HEADING = re.compile(r"(?:^|\s)(?:header|masthead|topbar|banner)(?=\s|$)", re.I)
#: Why an element is skipped: its element name, or a name, ``hidden`` or being a form, which can wrap a whole page.
_BY_ELEMENT, _BY_NAME = 1, 2
#: What evidence of a name leaves of an element's sum.
NAMED = 0.2
#: Shares of an element's text that must be selected for it to count as a whole.
WHOLE, WHOLE_ARTICLE = 0.8, 0.5


#: Up to one of these a block's start looks for an open paragraph.
_PARENTS = frozenset("p div article section td li body blockquote main html".split())
_CLOSING = frozenset(n for own, limits in CLOSES.values() for n in own | limits)


class Node:
    __slots__ = ("article", "children", "chars", "density", "ends", "links", "link_tags", "name", "own", "parent", "parts", "skip", "tags", "total", "within")

    def __init__(self, name: str, parent: Node | None, skip: int = 0):
        self.name, self.parent, self.skip = name, parent, skip
        self.children: list[Node] = []
        self.parts: list = []  # texts and child nodes, in page order
        self.own: int | None = None
        self.chars = self.tags = self.links = self.link_tags = 0
        self.density = self.total = 0.0
        #: Of this node and those around it: whether one is an article, the nearest of _PARENTS, and per kind of CLOSES the outermost that its start ends.
        self.article: bool = name in ("article", "main") or parent is not None and parent.article
        self.within: Node | None = self if name in _PARENTS or parent is None else parent.within
        self.ends: dict[str, Node | None] = parent.ends if parent is not None else {}
        if name in _CLOSING:
            self.ends = {k: None if name in limits else self.ends.get(k) or (self if name in own else None) for k, (own, limits) in CLOSES.items()}


def _skipped(name: str, attrs: str, inside_article: bool) -> int:
    if name in SKIP or name == "header" and not inside_article:
        return _BY_NAME if name == "form" else _BY_ELEMENT
    if not attrs or name in ("body", "html", "main", "article"):
        return 0
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role") and (_named(value, name in RUNNING) or not inside_article and _HEADING.search(value)) or key == "hidden" and value.lower() != "until-found" or key == "aria-hidden" and value.lower() == "true":
            return _BY_NAME
    return _BY_NAME if "hidden" in attrs.lower() and "hidden" in _ATTR.sub(" ", attrs).lower().strip("/").split() else 0


def _named(value: str, whole: bool) -> bool:
    return bool(_NAMED.search(value)) and (not whole or all(map(_NAMED.fullmatch, value.split())))


def _keep_wrappers(root: Node) -> None:
    """Takes the mark off navigation, header, footer and aside that hold all of the page's articles."""
    nodes = [root]
    for x in nodes:
        nodes.extend(x.children)
    if not any(x.skip == _BY_ELEMENT and x.children for x in nodes):
        return
    held: dict[int, int] = {}  # articles below
    for x in reversed(nodes):
        held[id(x)] = sum(held[id(c)] for c in x.children) + (x.name in ("article", "main"))
    for x in nodes:
        if x.skip == _BY_ELEMENT and held[id(x)] and held[id(x)] == held[id(root)]:
            x.skip = 0


def _leave(at: Node, to: Node, opened: Counter) -> Node:
    """Closes what is open below ``to``."""
    while at is not to:
        opened[at.name] -= 1
        at = at.parent
    return to


def parse(page: str) -> Node:
    """The tree of elements, skipped ones marked."""
    root = at = Node("html", None)
    pos, has_body, opened = 0, False, Counter()
    for m in iter(lambda: _TOKEN.search(page, pos), None):
        if m.start() > pos:
            at.parts.append(page[pos : m.start()])
        pos = m.end()
        end_mark, name, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        name = (name or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                at.parts.append(m[0][9:].removesuffix("]]>"))
            continue
        if end_mark:
            if opened[name] and name != "html":
                hit = at
                while hit.name != name:
                    hit = hit.parent
                at = _leave(at, hit.parent, opened)
            continue
        if name in ("html", "body") and (name == "html" or has_body):
            continue
        if name in BLOCK and at.within.name == "p":  # a paragraph and a heading end where a block starts
            at = _leave(at, at.within.parent, opened)
        if name in CLOSES and at.ends.get(name) is not None:
            at = _leave(at, at.ends[name].parent, opened)
        node = Node(name, at, _skipped(name, attrs, at.article))
        has_body |= name == "body" and at is root
        at.children.append(node)
        at.parts.append(node)
        if name in VOID or attrs.endswith("/") and name not in BLOCK and name != "a":
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, pos)
            pos = end.end() if end else len(page)
            continue
        at = node
        opened[name] += 1
    at.parts.append(page[pos:])
    _keep_wrappers(root)
    return root


def _below(node: Node, least_skip: int) -> list[Node]:
    """The node and all below it, parents first, without what is skipped for a reason of least_skip or more."""
    out = [node]
    for x in out:
        out.extend(c for c in x.children if not c.skip or c.skip > least_skip)
    return out


def weigh(root: Node, least_skip: int) -> list[Node]:
    """Sets characters, tags, densities and sums; returns the nodes, parents first."""
    nodes = _below(root, least_skip)
    for x in reversed(nodes):
        if x.own is None:
            x.own = sum(len("".join(html.unescape(p).split())) for p in x.parts if isinstance(p, str))
        kids = [c for c in x.children if not c.skip or c.skip > least_skip]
        x.chars = x.own + sum(c.chars for c in kids)
        x.tags = len(kids) + sum(c.tags for c in kids)
        x.links, x.link_tags = (x.chars, x.tags + 1) if x.name == "a" else (sum(c.links for c in kids), sum(c.link_tags for c in kids))
    ratio = root.links / max(1, root.chars)
    for x in reversed(nodes):
        tags, links, link_tags = max(1, x.tags), max(1, x.links), max(1, x.link_tags)
        x.density = 0.0
        if x.chars:
            base = max(_LEAST_BASE, math.log(x.chars * x.links / max(1, x.chars - x.links) + ratio * x.chars + math.e))
            x.density = x.chars / tags * max(0.0, math.log(x.chars / links * tags / link_tags, base))
        x.total = sum(c.density for c in x.children if not c.skip or c.skip > least_skip) or x.density
    return nodes


def _accept_core(root: Node) -> None:
    """Takes the name off what the core lies in, after names have lowered the sums."""
    nodes = weigh(root, _BY_ELEMENT)
    if not any(x.skip for x in nodes):
        return
    body = next((x for x in nodes if x.name == "body"), root)
    named: set[int] = set()
    core, best = body, -1.0
    for x in _below(body, _BY_ELEMENT):  # parents first
        if x.skip or x.parent is not None and id(x.parent) in named:
            named.add(id(x))
        if id(x) in named:
            score = x.total * NAMED
        else:
            score = sum(c.density * (NAMED if c.skip else 1.0) for c in x.children if c.skip != _BY_ELEMENT) or x.density
        if score > best:
            core, best = x, score
    hit: Node | None = core
    while hit is not None:
        hit.skip, hit = 0, hit.parent


_ALL = 9


def select(root: Node) -> list[Node]:
    """The selected subtrees in page order, none inside another."""
    _accept_core(root)
    nodes = weigh(root, _ALL)
    body = next((x for x in nodes if x.name == "body"), root)
    pool = _below(body, _ALL)
    if not body.chars:
        return []
    core = max(pool, key=lambda x: x.total)  # the first of equal ones
    threshold, hit = core.density, core
    while hit is not None and hit is not body.parent:
        threshold, hit = min(threshold, hit.density), hit.parent
    best: dict[int, Node] = {}
    for x in reversed(pool):
        best[id(x)] = max([x, *(best[id(c)] for c in x.children if not c.skip)], key=lambda y: y.total)
    chosen = {id(core)} | {id(best[id(x)]) for x in pool if x.density >= threshold > 0 and x is not body}
    # characters and link characters of the selected parts, upwards
    got: dict[int, tuple[int, int]] = {}
    for x in reversed(pool):
        below = [got[id(c)] for c in x.children if not c.skip]
        got[id(x)] = (x.chars, x.links) if id(x) in chosen else (sum(c for c, _ in below), sum(n for _, n in below))
    out, todo = [], [body]
    while todo:
        x = todo.pop()
        chars, links = got[id(x)]
        if not chars:
            continue
        article = x.name in ("article", "main")
        rest, rest_links = x.chars - chars, x.links - links
        whole = x is not body and chars >= (WHOLE_ARTICLE if article else WHOLE) * x.chars and (article or 2 * rest_links <= rest)
        if id(x) in chosen or whole:
            out.append(x)
        else:
            todo.extend(c for c in reversed(x.children) if not c.skip)
    return out


def blocks(node: Node) -> list[str]:
    """The texts of the node's blocks in page order."""
    out: list[str] = []
    buffer: list[str] = []

    def flush():
        text = " ".join(html.unescape("".join(buffer)).split())
        if text:
            out.append(text)
        buffer.clear()

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            buffer.append(x)
        elif not x.skip:
            if x.name in BLOCK:
                flush()
                todo.append(None)
            elif x.name == "br":
                buffer.append(" ")
            todo.extend(reversed(x.parts))
    flush()
    return out


def main_text(page: str | None) -> str:
    """The main text of one page."""
    return "\n".join(b for x in select(parse(page)) for b in blocks(x)) if page else ""


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, text and n_chars."""
    src = pages.select(F.col(id_col), F.col(url_col), F.col(html_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches):
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    types = [f.dataType.simpleString() for f in src.schema]
    return src.mapInArrow(run, f"`{id_col}` {types[0]}, `{url_col}` {types[1]}, text string, n_chars long")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
