"""Visible text of HTML pages, laid out: a tree with implied tags, rendered by blocks, lists and tables."""

from __future__ import annotations

import re
from collections.abc import Generator, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of elements by how they are parsed and shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head title script style template noscript noembed noframes iframe object audio video canvas datalist math svg map param source track".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul xmp".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul xmp dir".split())
LISTS = frozenset("ul ol menu dir".split())
# A start tag of the first kind ends an open element of the second, unless one of the third is met before.
IMPLIED_ENDS = {
    "li": ({"li"}, LISTS | {"td", "th", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
}
IMPLIED_ENDS["thead"] = IMPLIED_ENDS["tfoot"] = IMPLIED_ENDS["tbody"]
ENDS_P = BLOCK - {"body", "html", "legend", "option", "optgroup"}
P_STAYS = frozenset("button td th table caption body".split())

# Each mark is read once from its start: a quote opens a value only behind an equals sign and only where it is
# closed again, and a tag that the page never ends takes the rest of the page, as in a browser.
TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
SPACE = re.compile(r"[ \t\n\r\f]+")
WANTED = ("hidden", "style", "type", "start", "value", "reversed", "colspan", "rowspan", "open")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        if (name := name.lower()) in WANTED:
            found.setdefault(name, unescape(double or single or bare))
    return found


def parse(html: str) -> Node:
    """The tree of a page. Unclosed and missing tags are implied; what no rule covers keeps its text."""
    root = Node("html")
    stack = [root]
    places: dict[str, list[int]] = {}  # per tag the depths of its open elements

    def deepest(tags) -> int:
        return max((places[tag][-1] for tag in tags if places.get(tag)), default=0)

    def close(names, stops) -> None:
        depth = deepest(names)
        if depth and depth >= deepest(stops):
            while len(stack) > depth:
                places[stack.pop().tag].pop()

    def in_scope(names, stops) -> bool:
        return deepest(names) > deepest(stops)

    def add(node: Node, leaf: bool) -> None:
        stack[-1].children.append(node)
        if not leaf:
            places.setdefault(node.tag, []).append(len(stack))
            stack.append(node)

    def text(data: str) -> None:
        if data:
            stack[-1].children.append(unescape(data) if "&" in data else data)

    at, end = 0, len(html)
    while at < end:
        mark = TAG.search(html, at)
        if mark is None:
            text(html[at:])
            break
        text(html[at : mark.start()])
        at = mark.end()
        if mark["name"] is None:
            continue
        if not mark[0].endswith(">"):  # a tag without an end
            break
        name = mark["name"].lower()
        if mark["end"]:
            if name == "br":
                add(Node("br"), True)
            elif name not in ("html", "body"):
                inside = name in ("table", "caption", "td", "th", "tr", "tbody", "thead", "tfoot")
                close({name}, {"table"} - {name} if inside else {"td", "th", "caption"} | ({"button"} if name == "p" else set()))
            continue
        attrs = _attributes(mark["attrs"]) if mark["attrs"] else {}
        if name in ("html", "body"):
            if name == "body":
                close({"head"}, ())
            root.attrs = {**attrs, **root.attrs}
            continue
        if name in IMPLIED_ENDS:
            ended, stops = IMPLIED_ENDS[name]
            while in_scope(ended, stops):
                close(ended, stops)
        if name in ENDS_P and in_scope({"p"}, P_STAYS):
            close({"p"}, P_STAYS)
        if name in BLOCK and places.get("head"):
            close({"head"}, ())
        if name == "tr" and stack[-1].tag == "table":
            add(Node("tbody"), False)
        if name in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            if stack[-1].tag == "table":
                add(Node("tbody"), False)
            add(Node("tr"), False)
        node = Node(name, attrs)
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
            body = html[at : stop.start() if stop else end]
            node.children.append(unescape(body) if name in ("title", "textarea") else body)
            at = stop.end() if stop else end
            add(node, True)
        else:
            add(node, name in VOID)
    return root


def _style(node: Node, name: str) -> str:
    found = re.findall(rf"(?:^|;)\s*{name}\s*:\s*([a-z-]+)", node.attrs["style"].lower()) if "style" in node.attrs else []
    return found[-1] if found else ""


def _shown(node: Node) -> bool:
    display = _style(node, "display")
    if display:
        return display != "none" and node.tag not in ("script", "style", "template", "head", "title")
    if node.tag in HIDDEN or "hidden" in node.attrs:
        return False
    return node.tag != "dialog" or "open" in node.attrs


def _number(node: Node, name: str, default: int, least: int = 1, most: int = 1000) -> int:
    found = re.match(r"\s*(-?[0-9]{1,9})", node.attrs.get(name, ""))
    return min(max(int(found[1]), least), most) if found else default


class Flow:
    """Lines of a block under construction: inline text is gathered, blocks are set apart."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = False

    def text(self, data: str, exact: bool) -> None:
        if not exact:
            data = SPACE.sub(" ", data)
            if data[:1] == " " and (not self.inline or self.inline[-1][-1:] in (" ", "\n")):
                data = data[1:]
        if data:
            self.inline.append(data)

    def flush(self) -> None:
        if self.inline:
            lines = [line.rstrip(" ") for line in "".join(self.inline).split("\n")]
            while lines and not lines[-1]:
                lines.pop()
            while lines and not lines[0]:
                lines.pop(0)
            self.inline = []
            self.put(lines, False)

    def put(self, lines: list[str], spaced: bool) -> None:
        if lines:
            if self.lines and (spaced or self.gap):
                self.lines.append("")
            self.lines += lines
            self.gap = spaced

    def block(self, lines: list[str], spaced: bool) -> None:
        self.flush()
        self.put(lines, spaced)


def _indented(lines: list[str], first: str) -> list[str]:
    pad = " " * len(first)
    return [(first if at == 0 else pad if line else "") + line for at, line in enumerate(lines)]


def _done(task: Generator):
    """What a task returns. Tasks yield the tasks they wait for; these are kept in a list, not on the call
    stack, so that pages may be nested to any depth."""
    waiting, value = [task], None
    while waiting:
        try:
            task = waiting[-1].send(value)
        except StopIteration as end:
            waiting.pop()
            value = end.value
        else:
            waiting.append(task)
            value = None
    return value


def _render(node: Node, flow: Flow, exact: bool, seen: bool) -> Generator:
    """A task that adds the visible text of the children of ``node`` to ``flow``."""
    number, step = _number(node, "start", 1, -(10**9), 10**9), 1
    if node.tag == "ol" and "reversed" in node.attrs:
        items = sum(isinstance(child, Node) and child.tag == "li" for child in node.children)
        number, step = _number(node, "start", items, -(10**9), 10**9), -1
    closed = node.tag == "details" and "open" not in node.attrs
    for child in node.children:
        if isinstance(child, str):
            if seen and not closed:
                flow.text(child, exact)
            continue
        tag = child.tag
        if not _shown(child) or (closed and tag != "summary"):
            continue
        visible = {"hidden": False, "collapse": False, "visible": True}.get(_style(child, "visibility"), seen)
        display = _style(child, "display")
        if tag == "br":
            if visible:
                flow.text("\n", True)
        elif tag == "wbr":
            continue
        elif tag == "input":
            if visible and child.attrs.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel"):
                flow.text(child.attrs.get("value", ""), False)
        elif tag == "q":
            flow.text("“", True) if visible else None
            yield _render(child, flow, exact, visible)
            flow.text("”", True) if visible else None
        elif tag == "table":
            flow.block((yield _table(child, visible)), True)
        elif tag in BLOCK or display in ("block", "flex", "grid", "list-item"):
            if display.startswith("inline"):
                yield _render(child, flow, exact, visible)
                continue
            inner = Flow()
            yield _render(child, inner, exact or tag in ("pre", "xmp"), visible)
            inner.flush()
            lines = inner.lines
            if tag == "li":
                if node.tag == "ol":
                    number = _number(child, "value", number, -(10**9), 10**9)
                lines = _indented(lines, f"{number}. " if node.tag == "ol" else "- ")
                number += step
            elif tag == "blockquote" or tag == "dd":
                lines = _indented(lines, "  ")
            flow.block(lines, tag in SPACED and not (tag in LISTS and node.tag == "li"))
        else:
            yield _render(child, flow, exact or tag == "textarea" or _style(child, "white-space").startswith("pre"), visible)


def _rows(node: Node, seen: bool) -> Iterator[tuple[Node, bool]]:
    for child in node.children:
        if isinstance(child, Node) and _shown(child):
            visible = {"hidden": False, "collapse": False, "visible": True}.get(_style(child, "visibility"), seen)
            if child.tag == "tr":
                yield child, visible
            elif child.tag in ("tbody", "thead", "tfoot"):
                yield from _rows(child, visible)


def _lines(node: Node, seen: bool) -> Generator:
    flow = Flow()
    yield _render(node, flow, False, seen)
    flow.flush()
    return flow.lines


def _table(node: Node, seen: bool) -> Generator:
    """A task that gives rows of cells padded to the widths of their columns; spans keep their places."""
    outside = Node("div")
    outside.children = [c for c in node.children if isinstance(c, str) or c.tag not in ("tr", "tbody", "thead", "tfoot", "colgroup", "col")]
    lines, grid, held = (yield _lines(outside, seen)), [], {}
    for row, visible in _rows(node, seen):
        cells, column = {}, 0
        for cell in row.children:
            if isinstance(cell, str):
                if visible and cell.strip():
                    cells.setdefault(column, ([], 1))[0].append(SPACE.sub(" ", cell).strip())
                continue
            if not _shown(cell):
                continue
            while held.get(column, 0) > 0:
                column += 1
            wide = _number(cell, "colspan", 1)
            shown = {"hidden": False, "visible": True}.get(_style(cell, "visibility"), visible)
            cells[column] = ((yield _lines(cell, shown)), wide)
            for at in range(column, column + wide):
                held[at] = _number(cell, "rowspan", 1, most=65534)  # the limits of HTML itself, as for columns
            column += wide
        held = {at: left - 1 for at, left in held.items() if left > 1}
        grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        for column, (text, wide) in cells.items():
            if wide == 1:
                widths[column] = max(widths.get(column, 0), max(map(len, text), default=0))
    for cells in grid:
        for level in range(max((len(text) for text, _ in cells.values()), default=0)):
            line, offset = "", 0
            for column in range(max(cells) + 1):
                line = line.ljust(offset)
                if column in cells and level < len(cells[column][0]):
                    line += cells[column][0][level]
                offset += widths.get(column, 0) + (2 if widths.get(column) else 0)
                if line and column in cells and len(line) + 2 > offset and cells[column][1] == 1 and widths.get(column):
                    offset = len(line) + 2
            lines.append(line.rstrip())
    return lines


def visible_text(html: str) -> str:
    """The text a reader sees, line by line; empty for pages without any."""
    if not html:
        return ""
    tree = parse(html)
    if not _shown(tree):
        return ""
    return "\n".join(_done(_lines(tree, _style(tree, "visibility") not in ("hidden", "collapse"))))


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page_id, text): one row per row of ``pages``, the visible text of the whole page.

    Blocks start lines, paragraphs and the like are parted by an empty line, list items are marked and
    indented, table cells are padded to columns, preformatted text is kept. Heads, scripts, styles,
    templates, frames, closed details and elements hidden by attribute or inline style are left out;
    style sheets are not read. Null and empty pages give an empty text, text without tags comes back
    with its white space collapsed, a tag that is never ended is not shown, elements may be nested to any depth. Repeated rows stay; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(page or "") for page in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["page_id", "text"])

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col(html).cast("string").alias("html"))
    return narrow.mapInArrow(run, "page_id long, text string")
