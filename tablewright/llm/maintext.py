r"""Main text of HTML pages by minimum-cut labelling.

A page is read into blocks of text in order. Costs are a linear classifier of bounded features: words, links,
punctuation, kind of element, whether the block stands in an article, and the marks of the elements around it. Its sign and
size become a capacity to the source or to the sink. Blocks that follow each other, and neighbouring blocks of one
parent element, are joined by edges that cost less the farther apart they are in the tree. The minimum cut separates
content from boilerplate at the least sum of evidence overruled and edges cut; content is what the source still
reaches when the flow is maximal.

Marks. Elements made for boilerplate (navigation, footers, forms, hidden parts) and names in class and id mark what is
in them. In a name such as `article-sidebar` the last word says what the element is; a word before it (`menu-item`) is a weaker
mark, but for comments and adverts, and names that speak of layout (`has-sidebar`, `no-menu`, `ad-free`) are none. A form and the
weaker marks end where an article or main element begins. A mark adds to the other features and no mark is infinite.
There are no labelled pages to fit the weights on; they are set by hand and held against generated pages in the tests.

Text: character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined by one space. Inline tags add nothing between letters; block tags and <br> end or split.

Defined results: null or empty html gives the empty text; unclosed tags, quotes and comments are read
as browsers do or as text, never an error; a null page_id stays; repeated rows are separate; other
columns are ignored. A page is one row, so memory is that of its blocks.
"""

from __future__ import annotations

import html as references
import re
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import text_or_empty

SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long, n_content long"

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object select title".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose start ends an open element of the given kinds, up to the given borders.
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}
#: What boilerplate is in, by element, by role, and by words in class and id.
BAD_TAGS = frozenset("nav footer aside form button dialog menu head fieldset legend label".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
BAD_WORDS = frozenset(
    "banner sidebar sidebars aside menu menus nav navbar navigation navi breadcrumb breadcrumbs footer footers masthead topbar toolbar notice notices "
    "popup modal overlay signup login widget widgets pagination pager copyright disclaimer search skip".split()
)
#: These mark an element wherever they stand in a name.
WORST_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense promo promotion sponsor sponsored sponsors comment comments commentlist disqus reply replies "
    "respond reactions cookie cookies consent gdpr newsletter subscribe subscription share sharing social related recommended recommendations".split()
)
#: Names with these are about layout.
LAYOUT_WORDS = frozenset("has have no not with without free off hide none layout enabled disabled".split())
GOOD_WORDS = frozenset("article articlebody content entry main post story text body".split())

TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

#: Weights of marks (by element, by name, by a part of a name), of an article and of edges, in units of about ten words.
TAG_MARK, NAME_MARK, PART_MARK, IN_ARTICLE, NEAR, SIBLING = 20.0, 16.0, 4.0, 6.0, 1.0, 1.0


def name_mark(name: str) -> tuple[float, bool]:
    """The mark of one class or id, and whether an article inside ends it."""
    words = [w.lower() for w in NAME_PART.findall(name)]
    if not words or LAYOUT_WORDS.intersection(words):
        return 0.0, True
    if words[-1] in BAD_WORDS or WORST_WORDS.intersection(words):
        return NAME_MARK, False
    if words[-1] == "form":
        return NAME_MARK, True
    return (PART_MARK if BAD_WORDS.intersection(words) else 0.0), True


class Element:
    """firm: the mark that stays whatever is inside; loose: the mark that ends at an article."""

    __slots__ = ("tag", "parent", "depth", "firm", "loose", "good", "link")

    def __init__(self, tag: str, parent: Element | None, attributes: str = ""):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.firm, self.loose, self.good, self.link = (parent.firm, parent.loose, parent.good, parent.link) if parent else (0.0, 0.0, False, False)
        a = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
        role = a.get("role", "").lower()
        article = tag in ("article", "main") or role in ("article", "main")
        if article:
            self.loose = 0.0
        if tag == "a":
            self.link = True
        if tag == "form":
            self.loose = TAG_MARK
        elif tag in BAD_TAGS or tag == "header" and not self.good:
            self.firm = TAG_MARK
        if role in BAD_ROLES or "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", ""):
            self.firm = TAG_MARK
        if tag not in ("html", "body"):
            names = [n for k in ("class", "id") for n in a.get(k, "").split()]
            for mark, ends in map(name_mark, names):
                # An article may be named after what it is about.
                if not ends and not (article and not self.good):
                    self.firm = max(self.firm, mark)
                elif ends and not article:
                    self.loose = max(self.loose, mark)
            if any(not name_mark(n)[0] and GOOD_WORDS.intersection(w.lower() for w in NAME_PART.findall(n)) for n in names) and not self.mark:
                self.good = True
        self.good = self.good or article

    @property
    def mark(self) -> float:
        return max(self.firm, self.loose)


def blocks_of(page: str) -> list[tuple[str, Element, int]]:
    """(text, element, characters inside links) of each block with text, in page order."""
    out: list[tuple[str, Element, int]] = []
    root = top = Element("", None)
    buffer: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                holder = top
                while holder.parent and holder.tag not in BLOCK:
                    holder = holder.parent
                out.append((text, holder, linked))
            buffer.clear()
            linked = 0

    at, end = 0, len(page)
    search = TAG.search
    while at < end:
        m = search(page, at)
        data = page[at : m.start() if m else end]
        if data:
            data = references.unescape(data) if "&" in data else data
            buffer.append(data)
            if top.link:
                linked += len(data)
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        if m[1] or m[4]:
            if name in BLOCK:
                flush()
            e = top
            while e is not root and e.tag != name:
                e = e.parent
            if e is not root:
                top = e.parent
            elif name == "p":
                flush()
            continue
        if name in RAW:
            # Foreign elements may close themselves; without an end tag only these four run to the end of the page.
            if not (name in ("svg", "math") and m[0].endswith("/>")):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = close.end() if close else end if name in ("script", "style", "textarea", "title") else at
            continue
        if name in BLOCK:
            flush()
            if name != "br":
                e = top  # a block ends an open paragraph
                while e is not root and e.tag != "p" and (e.tag not in BLOCK):
                    e = e.parent
                if e.tag == "p":
                    top = e.parent
            if name in CLOSES:
                kinds, borders = CLOSES[name]
                e, found = top, None
                while e is not root and e.tag not in borders:
                    if e.tag in kinds.split():
                        found = e
                    e = e.parent
                if found:
                    top = found.parent
        if name not in VOID:
            top = Element(name, top, m[3] or m[6] or "")
    flush()
    return out


def evidence(text: str, e: Element, linked: int, has_article: bool) -> float:
    """Above 0 for content, below 0 for boilerplate."""
    words = text.count(" ") + 1
    s = min(words, 40) / 10 - 5 * min(1.0, linked / len(text)) - 1.0 - e.mark
    if text[-1] in ".!?:;\"')…»”":
        s += 1
    if e.tag == "p" or e.tag in HEADINGS:
        s += 1
    if e.good:
        return s + IN_ARTICLE
    return s - (IN_ARTICLE if has_article else 0)


def distance(a: Element, b: Element) -> int:
    """Steps between two elements in the tree."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def minimum_cut(evidences: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source. Maximal flow by blocking flows in layered graphs."""
    n = len(evidences)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, s in enumerate(evidences):
        if s > 0:
            join(source, i, s, 0.0)
        elif s < 0:
            join(i, sink, -s, 0.0)
    for a, b, c in edges:
        join(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque((source,))
        while queue:
            a = queue.popleft()
            for x in out[a]:
                b = to[x]
                if level[b] < 0 and room[x] > 1e-9:
                    level[b] = level[a] + 1
                    queue.append(b)
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(room[x] for x in path)
                for x in path:
                    room[x] -= least
                    room[x ^ 1] += least
                cut = next(k for k, x in enumerate(path) if room[x] <= 1e-9)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while tried[a] < len(out[a]):
                x = out[a][tried[a]]
                if room[x] > 1e-9 and level[to[x]] == level[a] + 1:
                    break
                tried[a] += 1
            else:
                if not path:
                    break
                a = to[path.pop() ^ 1]
                tried[a] += 1
                continue
            path.append(x)
            a = to[x]


def extract(page: str) -> tuple[str, int, int]:
    """Text, number of blocks, number of content blocks."""
    blocks = blocks_of(page)
    has_article = any(e.good and not e.mark for _, e, _ in blocks)
    scores = [evidence(t, e, n, has_article) for t, e, n in blocks]
    edges, last = [], {}
    for i, (_, e, _) in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEAR / (1 + distance(blocks[i - 1][1], e))))
        parent = id(e.parent)
        if parent in last:
            edges.append((last[parent], i, SIBLING / (i - last[parent])))
        last[parent] = i
    content = minimum_cut(scores, edges)
    kept = [t for (t, _, _), c in zip(blocks, content, strict=True) if c]
    return " ".join(kept), len(blocks), len(kept)


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_blocks, n_content."""

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            found = [extract(p) for p in batch.column(2).to_pylist()]
            text = [f[0] for f in found]
            more = [pa.array(c, pa.int64()) for c in (map(len, text), (f[1] for f in found), (f[2] for f in found))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), *more], ["page_id", "url", "text", "n_chars", "n_blocks", "n_content"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text_or_empty(html).alias("html"))
    return rows.mapInArrow(work, SCHEMA)
