"""Layout-aware text of HTML pages.

A tree builder with implied tags (paragraphs, list items, table parts and
options end where the next one begins; misnested end tags close what they can)
and visibility rules (head, scripts, templates, closed dialogs and details,
``hidden``, ``display:none``, ``visibility:hidden`` and its undoing) feeds a
renderer that emits all visible text: white space collapsed, blocks on lines of
their own with blank lines where a browser leaves a margin, list items with
bullets or numbers and indents, options on lines of their own, preformatted
text as it is, and table cells in aligned columns, whatever columns and rows
they span. A table inside a cell is part of the cell's text.

Tree and rendering use explicit stacks, and the open elements are indexed by
name, so a page of any depth takes time in proportion to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.textbytes import small_batches
from waymark.sources.tables import table

# Fixed values of HTML: elements by their parsing and rendering rules.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style xmp iframe noembed noframes title textarea".split())
INVISIBLE = frozenset("head script style template title iframe noembed noframes datalist object audio video canvas".split())
#: Inside ``svg`` and ``math``: what is not drawn itself.
FOREIGN = frozenset("svg math".split())
UNDRAWN = frozenset("desc metadata defs symbol clippath mask marker pattern annotation annotation-xml".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
                   "search section summary table ul caption thead tbody tfoot tr td th xmp option optgroup noscript "
                   "select".split())
MARGINS = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul xmp".split())
ENDS_P = BLOCKS - frozenset("body html td th tr thead tbody tfoot caption legend option optgroup noscript select".split())
LISTS = frozenset("ul ol menu dir".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag closes these open elements, searching up to one of the scopes.
IMPLIED = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    **{t: ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}) for t in ("thead", "tbody", "tfoot")},
}
GROUPS = frozenset("thead tbody tfoot".split())
SCOPES = frozenset("table td th caption html template".split())
IN_HEAD = frozenset("title meta link script style base noscript template".split())
TABLE_PARTS = GROUPS | {"table", "tr"}
#: Lines of lists nested deeper than this are not indented further; their markers are there all the same.
DEEPEST_INDENT = 32

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?--!?>|.*\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*"
    r"(?:[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=|[\"'])*?(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def attribute(self, name: str) -> str | None:
        """The attribute's value, empty if it has none, or None."""
        for key, a, b, c in _ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return unescape(a or b or c)
        return None


class _Open:
    """The open elements, and where those of each name are among them."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.places: dict[str, list[int]] = {root.tag: [0]}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def nearest(self, tags) -> int:
        return max([self.places[t][-1] for t in tags if self.places.get(t)], default=-1)

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            self.places[self.stack.pop().tag].pop()

    def close(self, tags, scopes) -> None:
        """Close the nearest open element of ``tags`` above the first of ``scopes``."""
        at = self.nearest(tags)
        if at > max(0, self.nearest(scopes)):
            self.cut(at)


def build_tree(html: str) -> Node:
    root = Node("html")
    open_ = _Open(root)
    stack, at, end = open_.stack, 0, len(html)
    while at < end:
        match = _TOKEN.search(html, at)
        text = html[at:match.start()] if match else html[at:]
        if text:
            if stack[-1].tag == "head" and not text.isspace():
                open_.cut(len(stack) - 1)
            stack[-1].children.append(text)
        if not match:
            break
        at, token = match.end(), match.group()
        if token[1] in "!?":
            continue
        if token[-1] != ">":
            break  # the page ends inside a tag
        name = _NAME.match(token)
        tag, closing = name.group(1).lower(), token[1] == "/"
        if closing:
            if tag == "br":
                stack[-1].children.append(Node("br"))
            elif tag == "p" and not open_.places.get("p"):
                stack[-1].children.append(Node("p"))
            elif tag in HEADINGS:
                open_.close(HEADINGS, SCOPES)
            else:
                # Inside a cell or caption only table tags close what is outside.
                open_.close({tag}, SCOPES - {tag} if tag not in IMPLIED and tag != "table" else {"table"} - {tag})
            continue
        if tag in ("html", "body") and open_.places.get(tag):
            continue
        if tag == "body":
            open_.close({"head"}, ())
        elif stack[-1].tag == "head" and tag not in IN_HEAD:
            open_.cut(len(stack) - 1)
        if tag in ENDS_P:
            open_.close({"p"}, SCOPES | {"button"})
        if tag in IMPLIED:
            open_.close(*IMPLIED[tag])
        if tag in GROUPS:
            open_.close({"tr"}, {"table"})  # a row without a group
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            open_.cut(len(stack) - 1)
        node = Node(tag, token[name.end():-1])
        stack[-1].children.append(node)
        foreign = tag in FOREIGN or any(open_.places.get(t) for t in FOREIGN)
        if foreign and token.endswith("/>"):
            continue
        if tag in RAW_TEXT:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            node.children.append(html[at:close.start()] if close else html[at:])
            if not close:
                break
            at = html.find(">", close.end()) + 1 or end
        elif tag not in VOID:
            open_.push(node)
    return root


class Flow:
    """Lines of a block container."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = 0        # blank lines owed before the next text
        self.space = False  # white space owed before the next text of the line
        self.bare = True    # no text in the container yet
        # Open list items: marker, and the gap and freshness before each.
        self.items: list[tuple[str, int, bool]] = []
        self.marked = 0     # items whose marker has been written
        self.indent = 0     # columns of their markers
        self.fresh = False  # no text yet in the innermost item

    def text(self, text: str, pre: bool) -> None:
        if pre:
            first, *more = text.replace("\r\n", "\n").split("\n")
            self._add(first)
            for line in more:
                self._end(True)
                self._add(line)
            return
        words = _SPACE.sub(" ", text)
        if words == " " or not words:
            self.space = self.space or bool(words and self.parts)
            return
        if words[0] == " ":
            self.space = self.space or bool(self.parts)
            words = words[1:]
        tail = words[-1] == " "
        self._add((" " if self.space else "") + (words[:-1] if tail else words))
        self.space = tail

    def _add(self, text: str) -> None:
        if text:
            if not self.parts and self.gap:
                if not self.bare:
                    self.lines += [""] * (self.gap - 1)
                self.gap = 0
            if not self.parts and self.items:
                self.parts.append(self._lead())
            self.bare = self.fresh = False
            self.parts.append(text)

    def _lead(self) -> str:
        """Indent of a line, and the markers that are due."""
        markers = [m for m, _, _ in self.items[self.marked:]]
        lead = " " * self.indent + "".join(markers)
        self.indent += sum(len(m) for m in markers[:max(0, DEEPEST_INDENT - self.marked)])
        self.marked = len(self.items)
        return lead

    def open_item(self, marker: str) -> None:
        self.block(0)
        self.items.append((marker, self.gap, self.fresh))
        self.fresh = True

    def close_item(self) -> None:
        """Margins inside the item end with it; an item without text leaves no trace."""
        self._end()
        marker, gap, fresh = self.items.pop()
        if self.marked > len(self.items):
            self.marked -= 1
            if self.marked < DEEPEST_INDENT:
                self.indent -= len(marker)
            self.gap, self.fresh = 1, False
        else:
            self.gap, self.fresh = gap, fresh

    def _end(self, forced: bool = False) -> None:
        if self.parts or (forced and not self.fresh):
            self.lines.append("".join(self.parts).rstrip(" "))
            self.parts = []
        self.space = False

    def line_break(self) -> None:
        if not self.parts and self.gap and not self.bare and not self.fresh:
            self.lines += [""] * (self.gap - 1)
            self.gap = 0
        self._end(not self.bare)

    def block(self, blank_lines: int) -> None:
        """A block begins or ends here."""
        self._end()
        if not self.fresh:
            self.gap = max(self.gap, blank_lines + 1)

    def add_lines(self, lines: list[str]) -> None:
        self.block(0)
        for line in lines:
            self._add(line)
            self._end(True)

    def result(self) -> list[str]:
        self._end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class Table:
    def __init__(self):
        self.rows: list[list[tuple[str, int, int]]] = []
        self.ends: list[int] = []  # rows up to and with each group that ended

    def end_group(self) -> None:
        self.ends.append(len(self.rows))

    def placed(self) -> list[list[tuple[int, int, str]]]:
        """``(column, columns, text)`` of every cell; a cell over several rows
        keeps its columns in them, up to the end of its group (0 rows mean all
        of the group)."""
        ends = iter([*self.ends, len(self.rows)])
        end, busy, out = next(ends), {}, []
        for y, row in enumerate(self.rows):
            while y >= end:
                end = next(ends)
            at, cells = 0, []
            for text, span, down in row:
                while busy.get(at, 0) > y:
                    at += 1
                cells.append((at, span, text))
                if down != 1:
                    last = min(y + down, end) if down else end
                    busy.update(dict.fromkeys(range(at, at + span), last))
                at += span
            out.append(cells)
        return out

    def lines(self) -> list[str]:
        """Cells in aligned columns, two spaces apart: a column begins where all
        cells that end before it have room."""
        placed = self.placed()
        # Cells by the column before which they end: what they need left of it.
        needs: dict[int, list[tuple[int, int]]] = {}
        for cells in placed:
            for at, span, text in cells:
                if text:
                    needs.setdefault(at + span, []).append((at, len(text) + 2))
        starts = [0]
        for column in range(1, max(needs, default=0) + 1):
            starts.append(max([starts[-1], *[starts[at] + size for at, size in needs.get(column, ())]]))
        out = []
        for cells in placed:
            line = ""
            for at, _, text in cells:
                if text:
                    line = line.ljust(starts[at]) + text
            if line:
                out.append(line)
        return out


def _style(node: Node) -> str:
    return _SPACE.sub("", node.attribute("style") or "").lower()


def _number(node: Node, name: str, pattern: str, default: int) -> int:
    value = node.attribute(name) if node.attributes else None
    return int(value) if value is not None and re.fullmatch(pattern, value.strip()) else default


class _Numbers:
    """The next number of an ``ol`` and its step."""

    def __init__(self, node: Node):
        back = bool(node.attributes) and node.attribute("reversed") is not None
        items = sum(1 for c in node.children if not isinstance(c, str) and c.tag == "li") if back else 1
        self.next, self.step = _number(node, "start", r"[+-]?\d{1,9}", items), -1 if back else 1

    def take(self, item: Node) -> int:
        number = _number(item, "value", r"[+-]?\d{1,9}", self.next)
        self.next = number + self.step
        return number


class _Frame:
    __slots__ = ("node", "at", "pre", "shown", "flow", "table", "cell", "list_depth", "foreign")

    def __init__(self, node, pre, shown, flow, table_, cell, list_depth, foreign):
        self.node, self.at = node, 0
        self.pre, self.shown, self.flow, self.table = pre, shown, flow, table_
        # Inside a cell; inside svg or math.
        self.cell, self.list_depth, self.foreign = cell, list_depth, foreign


def render(root: Node) -> str:
    top = Flow()
    numbers: dict[int, _Numbers] = {}
    stack = [_Frame(root, False, True, top, None, False, 0, False)]
    while stack:
        frame = stack[-1]
        node = frame.node
        if frame.at == len(node.children):
            stack.pop()
            if stack:
                _leave(frame, stack[-1])
            continue
        child = node.children[frame.at]
        frame.at += 1
        if isinstance(child, str):
            if frame.shown and not (frame.table is not None and node.tag in TABLE_PARTS and not child.strip()):
                frame.flow.text(unescape(child) if "&" in child else child, frame.pre)
            continue
        tag, shown = child.tag, frame.shown
        if tag == "br":
            if shown:
                frame.flow.line_break()
            continue
        if tag in INVISIBLE or (frame.foreign and tag in UNDRAWN):
            continue
        if child.attributes:
            style = _style(child)
            if "display:none" in style or child.attribute("hidden") is not None or (
                    tag == "input" and (child.attribute("type") or "").lower() == "hidden"):
                continue
            if "visibility:" in style:
                shown = "visibility:visible" in style or ("visibility:hidden" not in style
                                                          and "visibility:collapse" not in style and shown)
        if tag == "dialog" and child.attribute("open") is None:
            continue
        if tag == "details" and child.attribute("open") is None:
            # Closed: its first summary alone is seen.
            inner = [c for c in child.children if not isinstance(c, str) and c.tag == "summary"][:1]
            child = Node(tag, child.attributes)
            child.children = inner
        flow, table_, cell, depth = frame.flow, frame.table, frame.cell, frame.list_depth
        if tag == "table" and not cell:
            flow.block(1)
            table_ = Table()
        elif tag in GROUPS and table_ is not None:
            table_.end_group()  # rows before it are a group of their own
        elif tag == "tr" and table_ is not None:
            table_.rows.append([])
        elif tag in ("td", "th") and table_ is not None:
            if not table_.rows:
                table_.rows.append([])
            flow, table_, cell, depth = Flow(), None, True, 0
        elif tag in LISTS:
            flow.block(0 if depth else 1)
            depth += 1
            if tag == "ol":
                numbers[id(child)] = _Numbers(child)
        elif tag == "li":
            flow.open_item(f"{numbers[id(node)].take(child)}. " if node.tag == "ol" else "- ")
        elif tag in BLOCKS:
            flow.block(1 if tag in MARGINS else 0)
        stack.append(_Frame(child, frame.pre or tag in ("pre", "xmp"), shown, flow, table_, cell, depth,
                            frame.foreign or tag in FOREIGN))
    return "\n".join(top.result())


def _leave(frame: _Frame, outer: _Frame) -> None:
    node, tag, flow = frame.node, frame.node.tag, outer.flow
    if tag == "table" and frame.table is not None:
        flow.add_lines(frame.table.lines())
        flow.block(1)
    elif tag in ("td", "th") and outer.table is not None:
        span = min(max(_number(node, "colspan", r"\d{1,6}", 1), 1), 1000)
        down = min(_number(node, "rowspan", r"\d{1,6}", 1), 65534)
        outer.table.rows[-1].append((" ".join(" ".join(frame.flow.result()).split()), span, down))
    elif tag in GROUPS and outer.table is not None:
        outer.table.end_group()
    elif tag == "li":
        flow.close_item()
    elif tag in LISTS:
        flow.block(0 if outer.list_depth else 1)
    elif tag in BLOCKS:
        flow.block(1 if tag in MARGINS else 0)


def html_to_text(html: str | None) -> str:
    return render(build_tree(html)) if html else ""


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, text`` for every row: null and empty pages give an empty
    text; a page cut off inside a tag or comment loses that tag only; null and
    repeated ids are carried; other columns are dropped."""
    rows = pages.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_html"):
            texts = [html_to_text(h) for h in batch.column("_html").to_pylist()]
            yield pa.record_batch([batch.column("_id"), pa.array(texts, pa.string())], ["_id", "_text"])

    out = rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, _text string")
    return out.select(F.col("_id").alias(id_col), F.col("_text").alias("text"))


def op4_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return extract_text(table(spark, sf_dir, "pages", ["page_id", "html"]))
