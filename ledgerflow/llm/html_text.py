"""Main text of web pages by tag-path ratios.

A page's text nodes are grouped by the tag path from the root to the leaf
(``html/body/article/p/b``; a generic container also carries its class). Per
path, over the whole page:

* text ratio: characters of text outside links for each text node,
* punctuation ratio: sentence punctuation for each text node,
* both fused to one value, ``text * (1 + log(1 + punctuation)) * (1 - links)``,
  ``links`` being the share of the path's characters inside links.

Text nodes make blocks (paragraphs, headings, list items and the like). A
block's value is that of its paths, fused with that of all text that has the
same container path by their geometric mean. The values of the blocks, in page
order, are smoothed by a Gaussian window over neighbours of the same container,
or of one that holds the other, so that a headline or a short paragraph between
long ones gets their height. The height counts for the share of the block
outside links (headings: whole), and blocks that reach a share of the page's
mean height are content.

What the markup itself declares goes first: scripts, styles, forms, hidden
elements, and elements that by name, role, class or id are menus, footers,
sidebars, notices, adverts or reader comments. Where the page marks its article
(``article``, ``main``, ``articleBody``), only paths through that mark compete.
"""

from __future__ import annotations

import html as _entities
import re
from math import exp, log, sqrt

from pyspark.sql import DataFrame

from ledgerflow.llm.arrow import with_columns

#: Blocks on either side that the Gaussian window reaches, and its width in blocks.
SMOOTH_RADIUS, SMOOTH_SIGMA = 3, 1.5
#: A block is content when its smoothed value reaches this share of the mean over the page's characters: on pages
#: without a marked article, and inside a marked one, where little but lists of links is something else.
KEEP_SHARE, KEEP_SHARE_MARKED = 0.12, 0.04

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody
caption tfoot thead tr ul""".split())
CLOSES_P = BLOCK - {"body", "caption", "head", "html", "legend", "tbody", "tfoot", "thead", "tr"}
#: A start tag ends an open element of these names, up to the nearest boundary.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}),
        "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
        "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"})}
P_SCOPE = frozenset("button table td th caption object".split())
#: Elements that never hold an article's text.
DROPPED = frozenset("""head script style noscript template nav aside footer form fieldset button select option textarea input
label dialog iframe object embed svg math canvas audio video map noembed noframes menu search""".split())
DROPPED_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar
toolbar tablist""".split())
#: Words of a class or id that name something else than the article.
DROPPED_WORDS = frozenset("""ad ads adv advert adverts advertisement advertisements adsense adslot adbox banner sponsor
sponsored sponsors promo promotion promoted nav navbar navigation menu menus breadcrumb breadcrumbs topbar masthead footer
foot copyright colophon sidebar sidebars widget widgets aside cookie cookies consent gdpr notice notices alert popup modal
overlay paywall newsletter subscribe subscription signup login signin comment comments commentlist disqus replies respond
reply discussion feedback share sharing social related recommended recommendations recirculation trending popular pagination
pager skip toolbar search form tagcloud teaser teasers outbrain taboola hidden""".split())
#: Words that name the article itself; they outweigh a dropped word in the same class list.
ARTICLE_WORDS = frozenset("article articlebody content entry main post story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
GENERIC = frozenset("div section span table td ul ol".split())

_MARKUP = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?¡¿…、。！，：；？،؟।]")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Element:
    """An open element: its path from the root, and what it means for the text below it."""

    __slots__ = ("tag", "path", "dropped", "article", "linked")

    def __init__(self, tag: str, path: tuple, dropped: bool, article: bool, linked: bool):
        self.tag, self.path, self.dropped, self.article, self.linked = tag, path, dropped, article, linked


class Block:
    """A block's text nodes (path, text, in a link), its element, and the paths of what holds it and of what holds that."""

    __slots__ = ("nodes", "article", "tag", "container", "outer")

    def __init__(self, article: bool, tag: str, container: int, outer: int):
        self.nodes: list[tuple[int, str, bool]] = []
        self.article, self.tag, self.container, self.outer = article, tag, container, outer

    def related(self, other: Block) -> bool:
        """In the same container path, or in one that directly holds the other's."""
        return other.container in (self.container, self.outer) or self.container == other.outer

    def prose(self) -> float:
        """The share of the block that its height counts for."""
        if self.tag in HEADINGS:
            return 1.0
        sizes = [(len(text.strip()), linked) for _, text, linked in self.nodes]
        return sum(n for n, linked in sizes if not linked) / sum(n for n, _ in sizes)

    def text(self) -> str:
        return " ".join("".join(text for _, text, _ in self.nodes).split())


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), _entities.unescape(double or single or bare))
    return found


def _open(parent: _Element, tag: str, source: str) -> _Element:
    attributes = _attributes(source) if source and not source.isspace() else {}
    step = tag
    dropped, article = parent.dropped or tag in DROPPED, parent.article or tag in ("article", "main")
    if tag == "header" and not parent.article:
        dropped = True
    if attributes:
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
        words = {w.lower() for w in _WORD.findall(names)}
        role = attributes.get("role", "").lower()
        own = role in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody"
        article = article or own
        if not own and tag not in ("html", "body", "article", "main") and (
                role in DROPPED_ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
                or _HIDING.search(attributes.get("style", "")) or (words & DROPPED_WORDS and not words & ARTICLE_WORDS)
                or {"comment", "comments"} & words):
            dropped = True
        if tag in GENERIC and attributes.get("class"):
            step = tag + "." + ".".join(sorted(words))
    # A path is a linked pair (parent's path, step): equal for equal steps, shared by all nodes below, of any depth.
    return _Element(tag, (parent.path, step), dropped, article, parent.linked or tag == "a")


def blocks(source: str) -> list[Block]:
    """The page's blocks with text outside dropped elements, in page order."""
    out: list[Block] = []
    paths: dict[tuple[int, str], int] = {}

    def numbered(path: tuple) -> int:
        """Equal paths get one number; a step's parent is already a number."""
        return paths.setdefault(path, len(paths) + 1)

    stack = [_Element("", 0, False, False, False)]
    open_tags: dict[str, int] = {}
    block: Block | None = None
    at, size = 0, len(source)

    def push(element: _Element) -> None:
        element.path = numbered(element.path)
        stack.append(element)
        open_tags[element.tag] = open_tags.get(element.tag, 0) + 1

    def cut(depth: int) -> None:
        """Close all elements from ``depth`` on."""
        nonlocal block
        while len(stack) > depth:
            tag = stack.pop().tag
            open_tags[tag] -= 1
            if tag in BLOCK:
                block = None

    def close(tags: frozenset | set, borders: frozenset | set) -> None:
        """Close the outermost open element of ``tags`` above the nearest of ``borders``."""
        if not any(open_tags.get(t) for t in tags):
            return
        found = 0
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in tags:
                found = depth
            elif tag in borders:
                break
        if found:
            cut(found)

    def put(text: str) -> None:
        nonlocal block
        top = stack[-1]
        if top.dropped or not text:
            return
        if block is None:
            if text.isspace():
                return
            depth = len(stack) - 1
            while depth > 1 and stack[depth].tag not in BLOCK:
                depth -= 1
            block = Block(top.article, stack[depth].tag, stack[max(depth - 1, 0)].path, stack[max(depth - 2, 0)].path)
            out.append(block)
        block.nodes.append((top.path, _entities.unescape(text), top.linked))

    while at < size:
        less = source.find("<", at)
        if less < 0:
            put(source[at:])
            break
        put(source[at:less])
        m = _MARKUP.match(source, less) or _LOOSE.match(source, less)
        if m is None:  # a "<" that opens nothing is text
            put("<")
            at = less + 1
            continue
        at = m.end()
        if not m.group(2):
            continue
        if m.re is _LOOSE:  # a quotation mark that no other closes
            if not m.group().endswith(">"):
                continue  # a tag that the end of the page cuts off
            slash, tag, attributes = m.group(1), m.group(2), ""
        else:
            slash, tag, attributes = m.group(1), m.group(2), m.group(3)
        tag = tag.lower()
        if slash:
            if tag == "p" and not open_tags.get("p"):
                block = None
            elif open_tags.get(tag):
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                cut(depth)
            continue
        if tag in CLOSES_P and open_tags.get("p"):
            close({"p"}, P_SCOPE)
        if tag in ENDS:
            close(*ENDS[tag])
        if tag in ("td", "th", "br", "wbr", "img") and block is not None and tag != "wbr":
            block.nodes.append((stack[-1].path, " ", False))
        if tag in BLOCK:
            block = None
        if tag in VOID:
            continue
        element = _open(stack[-1], tag, attributes)
        if tag in RAW_TEXT:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else size
            continue
        push(element)
    return [b for b in out if b.text()]


class _Ratio:
    """Counts of the text nodes of one path, or of one container."""

    __slots__ = ("nodes", "chars", "links", "marks")

    def __init__(self) -> None:
        self.nodes = self.chars = self.links = self.marks = 0

    def add(self, chars: int, linked: bool, marks: int) -> None:
        self.nodes += 1
        self.chars += chars
        self.links += chars if linked else 0
        self.marks += marks

    def value(self) -> float:
        """Text and punctuation for each text node, fused, without links."""
        prose = self.chars - self.links
        return prose / self.nodes * (1 + log(1 + self.marks / self.nodes)) * (prose / self.chars)


def block_values(page: list[Block]) -> list[float]:
    """A block's value: the geometric mean of its paths' (by their characters in it) and its container's."""
    paths: dict[int, _Ratio] = {}
    containers: dict[int, _Ratio] = {}
    for b in page:
        for path, text, linked in b.nodes:
            stripped = text.strip()
            if stripped:
                marks = len(_PUNCTUATION.findall(stripped))
                paths.setdefault(path, _Ratio()).add(len(stripped), linked, marks)
                containers.setdefault(b.container, _Ratio()).add(len(stripped), linked, marks)
    by_path = {path: r.value() for path, r in paths.items()}
    by_container = {path: r.value() for path, r in containers.items()}
    out = []
    for b in page:
        weight = value = 0.0
        for path, text, _ in b.nodes:
            n = len(text.strip())
            if n:
                weight += n
                value += n * by_path[path]
        out.append(sqrt(value / weight * by_container[b.container]))
    return out


def smooth(page: list[Block], values: list[float]) -> list[float]:
    """Gaussian mean over the related neighbours in page order."""
    kernel = [exp(-0.5 * (d / SMOOTH_SIGMA) ** 2) for d in range(SMOOTH_RADIUS + 1)]
    out = []
    for i, b in enumerate(page):
        total = weight = 0.0
        for j in range(max(0, i - SMOOTH_RADIUS), min(len(page), i + SMOOTH_RADIUS + 1)):
            if b.related(page[j]):
                k = kernel[abs(i - j)]
                total += k * values[j]
                weight += k
        out.append(total / weight)
    return out


def content(source: str | None) -> list[str]:
    """The texts of a page's content blocks in page order."""
    page = blocks(source or "")
    marked = [b for b in page if b.article]
    page = marked or page
    if not page:
        return []
    heights = [h * b.prose() for b, h in zip(page, smooth(page, block_values(page)))]
    texts = [b.text() for b in page]
    mean = sum(len(t) * h for t, h in zip(texts, heights)) / sum(len(t) for t in texts)
    level = (KEEP_SHARE_MARKED if marked else KEEP_SHARE) * mean
    return [t for t, h in zip(texts, heights) if h >= level]


def extract(pages: DataFrame, html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text`` (content blocks joined by an empty line) and ``n_chars``, its code points.

    No shuffle: a page is one row. A null or empty page, and one without content, has an empty text. Repeated pages
    give equal texts, and there are no ties. A page of any length is read whole, in time linear in its length. Input
    columns named ``text`` or ``n_chars`` give way to the results; all others in ``carry`` (None: all) stay.
    """
    def compute(sources: list[str | None]) -> dict[str, list]:
        texts = ["\n\n".join(content(s)) for s in sources]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return with_columns(pages, [html_col], carry, "text string, n_chars long", compute)
