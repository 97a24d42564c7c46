"""Small tolerant HTML tree, used by the page readers inside tasks."""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

# A start or end tag, or a declaration. Possessive, so that broken markup costs no backtracking.
_TAG = re.compile(
    r"""<(?:(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)
      | [!?][^>]*+)>""",
    re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {tag: re.compile(rf"</{tag}\b", re.I) for tag in ("script", "style")}

_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track",
    "wbr",
}
# A start tag on the left ends an open element on the right, up to the nearest barrier.
_ENDS = {
    "td": {"td", "th"},
    "th": {"td", "th"},
    "tr": {"tr", "td", "th"},
    "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"},
    "thead": {"tbody", "thead", "tfoot", "tr", "td", "th"},
    "tfoot": {"tbody", "thead", "tfoot", "tr", "td", "th"},
    "li": {"li"},
    "option": {"option"},
}
_BARRIER = {"table", "ul", "ol", "select", "html"}

# A row as nearly all are: cells with text and a few properly nested inline elements, double quotes, lower-case tags. Such a
# row in an open table body opens and closes nothing but itself. Possessive throughout; anything else does not match.
_QUOTED = r"""(?:\s[^<>"']*+(?:"[^"]*+"[^<>"']*+)*+)?+"""
_INLINE = "a|abbr|b|em|i|small|span|strong|sub|sup"


def _nested(levels: int, cell: str) -> str:
    """Text with inline elements in one another, so many levels deep; the names of its groups are those of one kind of cell."""
    if levels == 0:
        return "[^<]*+"
    name, inner = f"inline_{cell}{levels}", _nested(levels - 1, cell)
    return rf"[^<]*+(?:<(?!/)(?:(?:br|img){_QUOTED}|(?P<{name}>{_INLINE}){_QUOTED}>{inner}</(?P={name}))>[^<]*+)*+"


_ROW_START = re.compile(rf"<tr({_QUOTED})>")
_PLAIN_CELL = re.compile(
    rf"[^<]*+<(?:(td{_QUOTED})>({_nested(3, 'd')})</td|(th{_QUOTED})>({_nested(3, 'h')})</th)>")
# Groups of the start tag and of the content: names inside have groups of their own.
_TD, _TH = (1, 2), (6, 7)
_ROW_END = re.compile(r"[^<]*+</tr>")
_LINK = re.compile(rf"<a({_QUOTED})>")
_INLINE_TAG = re.compile(rf"</?[a-z]++{_QUOTED}>")


class Node:
    __slots__ = ("_attrs", "children", "tag")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self._attrs, self.children = tag, attrs, []

    @property
    def attrs(self) -> dict[str, str]:
        """Attributes by lower-case name; the text of a tag is taken apart when first asked for."""
        if isinstance(self._attrs, str):
            self._attrs = attributes(self._attrs)
        return self._attrs

    def walk(self):
        """Descendant elements in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def find_all(self, *tags: str, cls: str | None = None, **attrs: str):
        for node in self.walk():
            if node.tag not in tags or (cls is not None and cls not in node.classes):
                continue
            if all(node.attrs.get(k.replace("_", "-")) == v for k, v in attrs.items()):
                yield node

    def find(self, *tags: str, cls: str | None = None, **attrs: str) -> Node | None:
        return next(self.find_all(*tags, cls=cls, **attrs), None)

    def all_rows(self):
        """Descendant rows in document order. A plain row holds no other, so it is not opened."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            if node.tag == "tr":
                yield node
            if not isinstance(node, PlainRow):
                stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def rows(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node) and c.tag == "tr"]

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def texts(self):
        stack = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, Node):
                stack.extend(reversed(item.children))
            else:
                yield item

    @property
    def text(self) -> str:
        """All text pieces, each stripped, put together without a separator."""
        return "".join(t.strip() for t in self.texts())


class PlainRow(Node):
    """A table row of plain cells: each is kept as its start tag and its content, nodes are built when first asked for."""

    __slots__ = ("_markup", "_nodes", "contents", "starts")

    def __init__(self, attrs: str, starts: list[str], contents: list[str], markup: str):
        self.tag, self._attrs, self.starts, self.contents = "tr", attrs, starts, contents
        self._markup, self._nodes = markup, None

    @property
    def children(self) -> list:
        if self._nodes is None:
            self._nodes = parse(self._markup, plain_rows=False)[0].children[0].children
        return self._nodes


def _plain_row(html: str, begin: int) -> tuple[PlainRow | None, int]:
    """The plain row that begins here and where it ends, if there is one."""
    row = _ROW_START.match(html, begin)
    if row is None:
        return None, begin
    starts, contents, position = [], [], row.end()
    while cell := _PLAIN_CELL.match(html, position):
        position = cell.end()
        start, content = cell.group(*_TD if cell.start(_TH[0]) < 0 else _TH)
        starts.append(start)
        contents.append(content)
    end = _ROW_END.match(html, position)
    if end is None:
        return None, begin
    return PlainRow(row[1], starts, contents, html[begin : end.end()]), end.end()


def attributes(text: str) -> dict[str, str]:
    """Attributes by lower-case name."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def plain_text(content: str) -> str:
    """What ``Node.text`` gives for a cell of a plain row."""
    if "<" not in content:
        return unescape(content).strip() if "&" in content else content.strip()
    text = ""
    for piece in _INLINE_TAG.split(content):
        if piece:
            text += unescape(piece).strip() if "&" in piece else piece.strip()
    return text


def plain_link(content: str) -> str | None:
    """Target of the first link with one in a cell of a plain row."""
    for attrs in _LINK.findall(content) if "<a" in content else ():
        if attrs.startswith(' href="') and "&" not in attrs:
            return attrs[7 : attrs.index('"', 7)]
        found = attributes(attrs)
        if "href" in found:
            return found["href"]
    return None


class _Tree:
    """Elements that are open while a page is read from left to right.

    Depths of open elements are kept per tag and per row or cell scope, so that a tag without a partner costs a look-up
    and not a walk over what is open; broken markup is read in linear time.
    """

    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.depths: dict[str, list[int]] = {}
        self.barriers = [0]

    def _cut(self, depth: int) -> None:
        for node in reversed(self.open[depth:]):
            self.depths[node.tag].pop()
            if node.tag in _BARRIER:
                self.barriers.pop()
        del self.open[depth:]

    def start(self, tag: str, attrs: str) -> None:
        first = None
        for other in _ENDS.get(tag, ()):
            depths = self.depths.get(other)
            if depths and depths[-1] > self.barriers[-1]:
                # The outermost one inside the nearest barrier ends, and all in it.
                place = bisect_right(depths, self.barriers[-1])
                first = depths[place] if first is None else min(first, depths[place])
        if first is not None:
            self._cut(first)
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.depths.setdefault(tag, []).append(len(self.open))
            if tag in _BARRIER:
                self.barriers.append(len(self.open))
            self.open.append(node)

    def end(self, tag: str) -> None:
        depths = self.depths.get(tag)
        tables = self.depths.get("table")
        if depths and (not tables or depths[-1] >= tables[-1]):
            self._cut(depths[-1])

    def text(self, data: str) -> None:
        self.open[-1].children.append(unescape(data) if "&" in data else data)


def parse(html: str, plain_rows: bool = True) -> tuple[Node, list[str]]:
    """Element tree and comments of a page; plain rows of a table body stay markup until they are looked into."""
    tree, comments = _Tree(), []
    text_from = position = 0
    last_tag_end = html.rfind(">")
    while -1 < (position := html.find("<", position)) < last_tag_end:
        begin, token = position, None
        if html.startswith("<!--", begin):
            stop = html.find("-->", begin + 4)
            comments.append(html[begin + 4 : stop if stop >= 0 else len(html)])
            position = stop + 3 if stop >= 0 else len(html)
        elif plain_rows and tree.open[-1].tag == "tbody" and (row := _plain_row(html, begin))[0]:
            if begin > text_from:
                tree.text(html[text_from:begin])
            tree.open[-1].children.append(row[0])
            text_from = position = row[1]
            continue
        elif token := _TAG.match(html, begin):
            position = token.end()
        else:
            position += 1  # a bare '<' belongs to the text
            continue
        if begin > text_from:
            tree.text(html[text_from:begin])
        if token and token["tag"]:
            tag = token["tag"].lower()
            if token["close"]:
                tree.end(tag)
            else:
                tree.start(tag, token["attrs"])
                if tag in _RAW_END:
                    raw_end = _RAW_END[tag].search(html, position)
                    position = raw_end.start() if raw_end else len(html)
        text_from = position
    if text_from < len(html):
        tree.text(html[text_from:])
    return tree.root, comments
