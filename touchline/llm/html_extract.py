"""Main text of HTML pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, less with each step; a container's
points are discounted by its share of link text. If the best container lies in an article or main element, that one is
kept, with the articles beside it. Else the container is kept, with all that stands beside it and is no list of
links, and further up with what holds paragraphs or is a heading.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out: by
element, or by a class, id or role that is one of the words below or is made of these and of words for places and
boxes alone (``site-footer``, ``left-sidebar``, ``adSlot3``; not ``no-sidebar``, ``page-header``, ``market-share``). An
element that is marked by such a name is kept all the same if it holds more than half of the page's points and the
page's article, main or h1 elements too; or all points, on a page without such elements. Reader comments never are.

The parser runs per page in a batch reader; time is linear in the page, for broken markup too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm.common import ship

# Elements that are never part of an article's text.
_SKIP = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea input label "
    "iframe object embed svg canvas video audio map dialog menu fieldset".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset(
    "html body address article blockquote center dd details div dl dt fieldset figcaption figure form h1 h2 h3 h4 h5 "
    "h6 header hr hgroup li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside footer caption "
    "noscript dialog menu".split()
)
# An opening tag ends these open elements, up to the nearest element of the second set.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Names of reader comments.
_COMMENTS = frozenset("comment comments disqus replies respond discussion".split())
# Words of class, id and role that mark what is no article.
_AWAY = _COMMENTS | frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs cookie cookies "
    "consent footer header masthead menu nav navbar navigation newsletter notice popup modal promo promoted promotion "
    "related recommended share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget "
    "complementary contentinfo search alert dialog".split()
)
# Words that may stand beside one of these in a name.
_PLACES = frozenset(
    "site main top bottom left right side box bar block blocks list lists area wrap wrapper container section item items "
    "link links button buttons icon icons panel global primary secondary sticky fixed inner outer slot unit form posts "
    "articles stories reader readers user thread feed media message group row col column overlay signup count "
    "title body text content footer header nav menu widget widgets".split()
)
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NUMBERS = re.compile(r"\d+(?:x\d+)?")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# From this share of link text on, an element is a list of links.
_LINKED = 0.33
_PARAGRAPH = frozenset("p pre td blockquote li dd div section article main body".split())


class _Node:
    __slots__ = ("tag", "parent", "children", "away", "mark", "points", "mass", "heads", "text", "links")

    def __init__(self, tag: str, parent: _Node | None, away: bool, mark: str = ""):
        self.tag, self.parent, self.away, self.mark = tag, parent, away, mark
        self.children: list[_Node | str] = []
        self.points, self.mass, self.heads, self.text, self.links = 0.0, 0.0, 0, 0, 0


def _is_away(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether an element is left out whatever it holds."""
    if tag in _SKIP or (tag == "header" and not in_article):
        return True
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and value and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _mark(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """``comments`` or ``other`` if a name marks the element as no part of an article, else nothing."""
    found = ""
    if tag in ("html", "body", "article", "main"):
        return found
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            for token in value.split():
                parts = _PARTS.findall(_NUMBERS.sub(" ", _CAMEL.sub(" ", token).lower()))
                if parts and not _AWAY.isdisjoint(parts) and all(p in _AWAY or p in _PLACES for p in parts):
                    if not _COMMENTS.isdisjoint(parts):
                        return "comments"
                    found = "other"
    return found


class _Tree(HTMLParser):
    """The element tree; what is to be left out stays in it, marked away, with everything inside."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", None, False)
        self.nodes: list[_Node] = []
        self.open: dict[str, int] = {}

    def _close_to(self, node: _Node) -> None:
        while True:
            now, self.at = self.at, self.at.parent
            self.open[now.tag] -= 1
            if now is node:
                return

    def _end_open(self, tags: set[str], limits: set[str]) -> None:
        """End the open elements of ``tags`` above the nearest one of ``limits``."""
        if not any(self.open.get(t) for t in tags):
            return
        node, last = self.at, None
        while node.parent is not None and node.tag not in limits:
            if node.tag in tags:
                last = node
            node = node.parent
        if last is not None:
            self._close_to(last)

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            self.at.children.append(" " if tag != "hr" else _Node("hr", self.at, False))
            return
        if tag in _BLOCK and self.open.get("p"):
            self._end_paragraph()
        if tag in _ENDS:
            self._end_open(*_ENDS[tag])
        away = self.at.away or _is_away(tag, attrs, bool(self.open.get("article")))
        node = _Node(tag, self.at, away, "" if away else _mark(tag, attrs))
        self.at.children.append(node)
        self.nodes.append(node)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.at = node

    def _end_paragraph(self) -> None:
        """A block ends an open paragraph, and the inline elements left open in it."""
        node = self.at
        while node.parent is not None and (node.tag == "p" or node.tag not in _BLOCK):
            if node.tag == "p":
                self._close_to(node)
                return
            node = node.parent

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.open.get(tag):
            return
        node = self.at
        while node.tag != tag:
            if tag not in _BLOCK and node.tag in _BLOCK:
                return  # an inline end tag does not end blocks
            node = node.parent
        self._close_to(node)

    def handle_data(self, data):
        self.at.children.append(data)


def _own_points(node: _Node) -> float:
    """Points of a paragraph by its own text: inline elements belong to it, blocks do not."""
    if node.away or node.tag not in _PARAGRAPH:
        return 0.0
    inner, commas = 0, 0
    stack = list(node.children)
    while stack:
        child = stack.pop()
        if isinstance(child, str):
            inner += len(child.strip())
            commas += child.count(",")
        elif child.tag not in _BLOCK and not child.away:
            stack.extend(child.children)
    return 0.0 if inner < 25 else 1 + commas + min(inner / 100, 3)


def _drop_marked(tree: _Tree) -> None:
    """Leave marked elements out, but for one that holds what the page is about.

    Comments count for no half: a long discussion does not make a short article a part of it.
    """
    whole, heads = 0.0, 0
    for node in tree.nodes:
        if node.parent.mark == "comments":
            node.mark = "comments"
        if node.mark != "comments" and not node.away:
            node.mass, node.heads = _own_points(node), int(node.tag in ("article", "main", "h1"))
            whole, heads = whole + node.mass, heads + node.heads
    for node in reversed(tree.nodes):
        node.parent.mass += node.mass
        node.parent.heads += node.heads
    for node in tree.nodes:
        marked = node.mark == "comments" or node.mark == "other"
        if node.mark == "other" and (node.heads > 0 if heads else node.mass == whole) and 2 * node.mass > whole:
            marked = False
        node.away = node.away or node.parent.away or marked


def _scores(tree: _Tree) -> None:
    """Lengths of text and link text of every node, then the points of paragraphs on their ancestors."""
    order = tree.nodes
    for node in order:
        node.text = 0 if node.away else sum(len(c.strip()) for c in node.children if isinstance(c, str))
    for node in reversed(order):
        if node.tag == "a":
            node.links = node.text
        if not node.away:
            node.parent.text += node.text
            node.parent.links += node.links
    for node in order:
        points = _own_points(node) * (1 - _density(node))
        if not points:
            continue
        if node.tag not in ("p", "pre", "blockquote", "li", "td", "dd"):
            node.points += points
        up, step = node.parent, 1
        while up is not None and step <= 4:
            up.points += points / step
            up, step = up.parent, step + 1


def _density(node: _Node) -> float:
    """Share of link text."""
    return min(node.links / node.text, 1.0) if node.text else 0.0


def _is_prose(node: _Node) -> bool:
    return not node.away and node.text > 0 and _density(node) < _LINKED


def _holds_paragraph(tree: _Tree) -> set[_Node]:
    """Nodes with a paragraph of some length in them, at any depth."""
    found: set[_Node] = set()
    for node in reversed(tree.nodes):
        if node in found or _own_points(node) > 0:
            found.update((node, node.parent))
    return found


def _container(tree: _Tree) -> list[_Node | str]:
    """What is kept, in page order."""
    best, most = None, 0.0
    for node in tree.nodes:
        if node.away or node.tag in ("html", "p"):
            continue
        score = node.points * (1 - _density(node))
        if score > most:
            best, most = node, score
    if best is None:
        # No paragraph is long enough: an article or main element, or the body.
        named = [n for n in tree.nodes if n.tag in ("article", "main") and not n.away]
        return named[:1] or [n for n in tree.nodes if n.tag == "body"][:1] or [tree.root]
    node, article, main = best, None, None
    while node is not None:
        if node.tag == "article":
            article = node
        elif node.tag == "main":
            main = node
        node = node.parent
    if article is not None:
        beside = [c for c in article.parent.children if isinstance(c, _Node) and c.tag == "article"]
        return [c for c in beside if c is article or (_is_prose(c) and c.points > 0)]
    if main is not None:
        return [main]
    kept: list[_Node | str] = [best]
    with_paragraphs = _holds_paragraph(tree)
    node = best
    while node.tag != "body" and node.parent is not None:
        here: list[_Node | str] = []
        for child in node.parent.children:
            if child is node:
                here += kept
            elif isinstance(child, str):
                if node is best:
                    here.append(child)
            elif _is_prose(child) and (node is best or child in with_paragraphs or child.tag in _HEADINGS):
                here.append(child)
        kept, node = here, node.parent
    return kept


def _blocks(nodes: list[_Node | str]) -> list[str]:
    """Texts of the blocks in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    for root in nodes:
        if isinstance(root, _Node) and root.tag in _BLOCK:
            flush()
        stack: list = [root]
        while stack:
            child = stack.pop()
            if isinstance(child, str):
                run.append(child)
            elif child is None:
                flush()
            elif not child.away:
                if child.tag == "header":
                    # Of the header of an article only its headings are text.
                    flush()
                    stack.append(None)
                    stack.extend(reversed([c for c in child.children if isinstance(c, _Node) and c.tag in (*_HEADINGS, "hgroup")]))
                    continue
                if child.tag in _BLOCK:
                    flush()
                    stack.append(None)
                stack.extend(reversed(child.children))
    flush()
    return out


def main_text(html: str) -> str:
    """The main text of one page: blocks joined by line breaks."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    _drop_marked(tree)
    _scores(tree)
    return "\n".join(_blocks(_container(tree)))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py() or "") for h in batch["html"]]
        yield pa.RecordBatch.from_arrays([
            batch["page_id"].cast(pa.int64()), batch["url"].cast(pa.string()), pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64()),
        ], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a block (line break elements too) is one blank, blocks
    are joined by a line break. Null and empty pages, and pages without text, give the empty text. Every row is
    kept, repeated ones and null ids and urls too. An empty table gives an empty result. Other columns are ignored.
    """
    ship(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )
