"""Main text of web pages by composite text density.

A page becomes a tree without what is never article text: scripts, styles, forms, menus, page
headers, footers, sidebars, notices, adverts and reader comments, told by tag, role, class or
id. A class or id alone removes no article element, nothing that holds the page's largest
article or main element, unless the text without any such name is over twice as long, and
nothing that holds most of the page's unlinked text while no other article or main element
without such a name has any. Every node gets its composite density: characters per tag, adjusted by the share of links
among its characters and tags and in the body. The node with the largest sum of its children's
densities is the core. It grows to the outermost ancestor below the body that is as dense as
the body. Around it, a subtree is content if less than half of its characters are links and its
density reaches the least density on the path from the core to the body; headings, paragraphs,
lists, quotes, tables, sections and articles need not reach it, since short ones belong to the
text as well. Where most of the text stands in paragraphs of the body itself, so that the body
is the core, its other children have to reach that density too. Loose text stays beside a core
that is no article or main element, else by the same threshold.

Null and empty pages have an empty text, as pages with nothing but the above. Rows stay one
by one; only page_id, url and html are read. Trees are arrays, so depth and length of a page
are bounded by memory alone.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesengine.llm.common import table

# Fixed values of HTML, and names that pages commonly give to what is not article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
DROPPED_TAGS = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form head iframe input map menu "
    "nav noscript object option script select style svg template textarea title video".split()
)
INVISIBLE_TAGS = frozenset("datalist noscript script style template title".split())
DROPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising aside banner breadcrumb breadcrumbs byline-share "
    "comment comments consent cookie cookies copyright disqus footer form gdpr hidden login masthead "
    "menu menus modal nav navbar navigation newsletter notice notices pager pagination paywall popup "
    "promo promoted promotion recommended related replies reply respond search share sharing sidebar "
    "sidebars signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets".split()
)
DROPPED_WHOLE = frozenset("header site-header page-header main-header global-header top-header".split())
NEGATED = frozenset("has no with without".split())
# Last parts of class names that state a layout or a state: sidebar-right, comments-open, hidden-xs.
LAYOUT = frozenset(
    "active closed collapsed desktop disabled enabled layout left lg md mobile none off on open phone print right "
    "sm tablet xl xs xxl".split()
)
MARKED = frozenset("article main".split())
TEXT_TAGS = frozenset("article blockquote dd dl figure h1 h2 h3 h4 h5 h6 li main ol p pre section table td th ul".split())
CLOSED_BY = {  # an open element, and the start tags that end it
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
    "td": {"td", "th", "tr", "tbody", "tfoot", "thead"}, "th": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
}
CLOSING = frozenset().union(*CLOSED_BY.values())
SCOPES = frozenset("ul ol dl table select html body".split())
_PART = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")


def dropped(tag: str, attributes: dict[str, str | None], in_article: bool) -> bool:
    """Whether an element and all below it is no article text, whatever it holds."""
    if tag in DROPPED_TAGS or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body", "main"):
        return False
    if "hidden" in attributes or (attributes.get("role") or "").lower() in DROPPED_ROLES:
        return True
    return attributes.get("aria-hidden") == "true" or "display:none" in (attributes.get("style") or "").replace(" ", "")


def suspected(tag: str, attributes: dict[str, str | None]) -> bool:
    """Whether a class or id of an element is that of what is not article text."""
    if tag in ("html", "body", "main", "article"):
        return False
    for key in ("class", "id"):
        for name in (attributes.get(key) or "").split():
            parts = [p.lower() for p in _PART.split(name) if p]
            if not parts or not NEGATED.isdisjoint(parts[:-1]):
                continue
            if key == "class" and len(parts) > 1 and parts[-1] in LAYOUT:
                continue
            if parts[0] in DROPPED_NAMES or parts[-1] in DROPPED_NAMES or "-".join(parts) in DROPPED_WHOLE:
                return True
    return False


class _Tree(HTMLParser):
    """Kept elements in document order (parent, tag) and the text between block borders."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tags = [-1], ["#root"]
        self.suspects: list[int] = []
        self.events: list[tuple[int, str | None]] = []  # node and its text, or None at a border
        self.stack: list[tuple[str, int]] = []  # open elements: tag, node or -1 inside dropped ones
        self.scopes: list[str] = []  # those of the open elements that list items and cells look at
        self.open: dict[str, int] = {}
        self.skipping = 0

    dropped = staticmethod(dropped)

    def _pop(self) -> str:
        tag, node = self.stack.pop()
        if tag in SCOPES or tag in CLOSED_BY:
            self.scopes.pop()
        self.open[tag] -= 1
        self.skipping -= node < 0
        if tag in BLOCK:
            self.events.append((0, None))
        return tag

    def _close_to(self, tag: str) -> None:
        while self._pop() != tag:
            pass

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.events.append((0, None))
            if self.open.get("p") and tag not in ("html", "body"):
                self._close_to("p")
        elif tag == "br":
            self.events.append((0, " "))
        if tag in CLOSING:
            for other in reversed(self.scopes):  # few: an open element of a kind ends the one before
                if tag in CLOSED_BY.get(other, ()):
                    self._close_to(other)
                    break
                if other in SCOPES:
                    break
        if tag in VOID:
            if not self.skipping:
                self._node(tag)
            return
        in_article = bool(self.open.get("article") or self.open.get("main"))
        attributes = dict(attrs)
        if self.skipping or self.dropped(tag, attributes, in_article):
            node = -1
            self.skipping += 1
        else:
            node = self._node(tag)
            if suspected(tag, attributes):
                self.suspects.append(node)
        self.stack.append((tag, node))
        if tag in SCOPES or tag in CLOSED_BY:
            self.scopes.append(tag)
        self.open[tag] = self.open.get(tag, 0) + 1

    def _node(self, tag: str) -> int:
        self.parent.append(self.stack[-1][1] if self.stack else 0)
        self.tags.append(tag)
        return len(self.tags) - 1

    def handle_endtag(self, tag: str) -> None:
        if not self.open.get(tag):
            return
        if tag not in BLOCK:  # an inline element ends inside its block only
            for other, _ in reversed(self.stack):
                if other == tag:
                    break
                if other in BLOCK:
                    return
        self._close_to(tag)

    def handle_data(self, data: str) -> None:
        if not self.skipping:
            self.events.append((self.stack[-1][1] if self.stack else 0, data))


class _Visible(_Tree):
    """A tree of all that a browser shows."""

    dropped = staticmethod(
        lambda tag, attributes, in_article: tag in INVISIBLE_TAGS
        or "hidden" in attributes
        or "display:none" in (attributes.get("style") or "").replace(" ", "")
    )


def visible_text(html: str | None) -> str:
    """All text that a page shows, with a line end at block borders."""
    tree = _Visible()
    tree.feed(html or "")
    tree.close()
    return "".join(["\n" if text is None else text for _, text in tree.events])


class _Sizes:
    """Characters, link characters, tags and links of the subtree of each node, and its end."""

    def __init__(self, tree: _Tree, gone: list[bool] | None = None) -> None:
        n = len(tree.tags)
        self.chars, self.link_chars, self.tags, self.links = [0] * n, [0] * n, [0] * n, [0] * n
        self.linked = [False] * n
        for node in range(1, n):
            self.linked[node] = tree.tags[node] == "a" or self.linked[tree.parent[node]]
        for node, text in tree.events:
            if text and not (gone and gone[node]):
                size = len("".join(text.split()))
                self.chars[node] += size
                self.link_chars[node] += size if self.linked[node] else 0
        self.end = list(range(1, n + 1))
        for node in range(n - 1, 0, -1):
            up = tree.parent[node]
            self.end[up] = max(self.end[up], self.end[node])
            if gone and gone[node]:
                continue
            self.chars[up] += self.chars[node]
            self.link_chars[up] += self.link_chars[node]
            self.tags[up] += self.tags[node] + 1
            self.links[up] += self.links[node] + (tree.tags[node] == "a")

    def plain(self, node: int) -> int:
        return self.chars[node] - self.link_chars[node]


def removed(tree: _Tree) -> list[bool] | None:
    """Whether each node lies in an element that its class or id removes; None if there is none."""
    if not tree.suspects:
        return None
    sizes = _Sizes(tree)
    n = len(tree.tags)
    gone, under = [False] * n, [False] * n
    for node in tree.suspects:
        under[node] = True
    clean = sizes.plain(0)  # unlinked text outside of all suspects
    outermost = [0] * n  # the unlinked text of the outermost marked element around
    inner = [0] * n  # that of the largest marked element inside
    for node in range(1, n):
        up = tree.parent[node]
        clean -= sizes.plain(node) if under[node] and not under[up] else 0
        under[node] |= under[up]
        outermost[node] = outermost[up] or (sizes.plain(up) if tree.tags[up] in MARKED else 0)
    for node in range(n - 1, 0, -1):
        own = sizes.plain(node) if tree.tags[node] in MARKED else 0
        inner[tree.parent[node]] = max(inner[tree.parent[node]], inner[node], own)
    ended, started = _Running(), _Running()  # marked elements by their end, and by their start from behind
    by_end = sorted((sizes.end[i], i) for i in range(n) if tree.tags[i] in MARKED)
    for end, i in by_end:
        ended.add(end, sizes.plain(i), not under[i])
    for i in range(n - 1, 0, -1):
        if tree.tags[i] in MARKED:
            started.add(-i, sizes.plain(i), not under[i])
    for node in tree.suspects:
        if gone[node]:
            continue
        end, own = sizes.end[node], sizes.plain(node)
        before, behind = ended.upto(node), started.upto(-end)
        around = outermost[node] - own if outermost[node] else 0
        largest = max(before[0], behind[0], around)
        if inner[node] > largest and 2 * inner[node] >= clean:
            continue
        if 2 * own > sizes.plain(0) and not (before[1] or behind[1]):
            continue
        gone[node:end] = [True] * (end - node)
    return gone


class _Running:
    """The largest value, and whether a counted value above 0 is there, up to a place."""

    def __init__(self) -> None:
        self.places: list[int] = []
        self.states: list[tuple[int, bool]] = []

    def add(self, place: int, value: int, counted: bool) -> None:
        largest, any_ = self.states[-1] if self.states else (0, False)
        self.places.append(place)
        self.states.append((max(largest, value), any_ or (counted and value > 0)))

    def upto(self, place: int) -> tuple[int, bool]:
        at = bisect_right(self.places, place)
        return self.states[at - 1] if at else (0, False)


def densities(tree: _Tree, sizes: _Sizes) -> tuple[list[float], list[float]]:
    """Composite density and density sum of each node."""
    n = len(tree.tags)
    share = sizes.link_chars[0] / max(1, sizes.chars[0])
    density, total = [0.0] * n, [0.0] * n
    for node in range(n):
        c, lc = sizes.chars[node], max(1, sizes.link_chars[node])
        t, lt = max(1, sizes.tags[node]), max(1, sizes.links[node])
        if c:
            base = math.log(c / max(1, sizes.plain(node)) * sizes.link_chars[node] + share * c + math.e)
            density[node] = c / t * math.log(max(math.e, c / lc * t / lt)) / base
        if node:
            total[tree.parent[node]] += density[node]
    return density, total


def main_text(html: str | None) -> str:
    """The blocks of the article, one a line."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    gone = removed(tree)
    sizes = _Sizes(tree, gone)
    end, parent = sizes.end, tree.parent
    density, total = densities(tree, sizes)
    body = next((i for i, tag in enumerate(tree.tags) if tag == "body"), 0)
    core = max((i for i in range(body, end[body]) if not (gone and gone[i])), key=lambda i: (total[i], -i))
    while core != body and parent[core] != body and density[parent[core]] >= density[body]:
        core = parent[core]
    path = [core]
    while path[-1] != body:
        path.append(parent[path[-1]])
    least = min(density[i] for i in path)
    in_marked = [False] * len(tree.tags)
    for node in range(1, len(tree.tags)):
        in_marked[node] = in_marked[parent[node]] or tree.tags[node] in MARKED
    texts = [tag in TEXT_TAGS for tag in tree.tags]
    for node in range(len(tree.tags) - 1, 0, -1):
        texts[parent[node]] |= texts[node]
    kept = [False] * len(tree.tags)

    def content(node: int) -> bool:
        if sizes.plain(node) <= sizes.link_chars[node]:
            return False
        return in_marked[node] or texts[node] or density[node] >= least

    ways = set(path)
    # Where paragraphs stand in the body itself, boxes beside them have to be as dense as it is.
    prose = sum(sizes.plain(i) for i in range(body + 1, end[body]) if parent[i] == body and texts[i])
    boxed = core == body and 2 * prose > sizes.plain(body)
    refused = [False] * len(tree.tags)  # boxes whose text is not even loose text
    for node in range(body, end[body]):
        if gone and gone[node]:
            continue
        block = tree.tags[node] in BLOCK
        if boxed and parent[node] == body and block and not content(node):
            refused[node] = True
        elif node != body and parent[node] >= body and kept[parent[node]]:
            kept[node] = True
        elif node == core or (node not in ways and (block or node == body) and content(node)):
            kept[node] = True
        elif node not in ways:
            refused[node] = block or refused[parent[node]]
    blocks, parts = [], []
    for node, text in [*tree.events, (0, None)]:
        if text is not None:
            if (node == 0 and text == " ") or (body <= node < end[body] and not (gone and gone[node])):
                parts.append((node, text))
            continue
        loose, size = [i for i, t in parts if not (kept[i] or refused[i]) and t != " "], [0, 0]
        for i, t in parts if loose else ():
            if not (kept[i] or refused[i]):
                size[sizes.linked[i]] += len("".join(t.split()))
        whole = size[0] > size[1] and (
            not in_marked[core] or any(in_marked[i] for i in loose) or size[0] * math.log(max(math.e, size[0])) >= least
        )
        block = " ".join("".join(t for i, t in parts if t == " " or kept[i] or (whole and not refused[i])).split())
        if block:
            blocks.append(block)
        parts = []
    return "\n".join(blocks)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html.as_py()) for html in batch.column("html")]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op4_html_text(spark, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))
