"""Visible text of HTML pages, laid out as a browser would: block spacing, lists, aligned table cells.

A tree is built with the implied tags of HTML: an open paragraph ends before a block, a list item before the next one,
cells and rows end and begin by themselves, text straight inside a table moves before it, and an end tag without its start is
ignored. Then all text that is visible is emitted and no other: nothing of head, script, style and the like, of elements with
``hidden`` or an inline ``display:none`` or ``visibility:hidden``, or of closed ``details``; of a ``select`` the chosen option.

Pages are independent rows, so the work is one narrow pass over the table.

Defined cases: a null page gives null, an empty one empty text. Repeated rows and null page_ids are rendered like others.
Broken markup never fails: what is no tag is text, an unclosed comment, script or style runs to the end. Tables inside
tables beyond ``MAX_TABLES`` levels are rendered as plain blocks. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TABLES = 8
MAX_SPAN = 1000

# Element names of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
             "legend li main menu nav ol optgroup option p pre search section summary table ul xmp".split())
SPACED = set("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul xmp".split())
HIDDEN = set("audio canvas datalist embed head iframe img input noembed noframes noscript object script style template title video".split())
FOREIGN = {"svg": set("defs desc metadata symbol".split()), "math": {"annotation", "annotation-xml"}}  # drawings and formulas, and what they do not show
LISTS = set("ul ol menu dir".split())
TABLE_PARTS = set("table thead tbody tfoot tr".split())

#: What a start tag ends, and what stops the search for it.
ENDS: dict[str, tuple[set[str], set[str]]] = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "caption"}, {"table"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}))}
P_STOPS = {"td", "th", "caption", "button", "table", "object", "html"}

_TOKEN = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>?|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
                    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []

    def get(self, name: str) -> str | None:
        """An attribute's value, empty if it has none, None if it is absent."""
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return html.unescape(m[2] or m[3] or m[4] or "")
        return None

    def visible(self) -> bool:
        if self.tag in HIDDEN:
            return False
        if not self.attributes:
            return True
        return self.get("hidden") is None and not _NOT_SHOWN.search(self.get("style") or "")


class TreeBuilder:
    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.inside = Counter()  # tags of the open elements

    def end(self, tags: set[str], stops: set[str]) -> bool:
        """Close the innermost open element of ``tags`` with all inside it, unless one of ``stops`` comes first."""
        if not any(self.inside[tag] for tag in tags):
            return False
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                self.inside.subtract(node.tag for node in self.open[k:])
                del self.open[k:]
                return True
            if self.open[k].tag in stops:
                return False
        return False

    def add(self, child: Node | str) -> None:
        here = self.open[-1]
        if here.tag in TABLE_PARTS and (isinstance(child, str) or child.tag not in TABLE_PARTS | {"td", "th", "caption", "col", "colgroup", "script", "style", "template"}):
            k = max(i for i, node in enumerate(self.open) if node.tag == "table")  # before the table, not in it
            if k:
                place = self.open[k - 1].children
                place.insert(next(i for i in range(len(place) - 1, -1, -1) if place[i] is self.open[k]), child)
                return
        here.children.append(child)

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body"):
            self.end({"head"}, set())
            return
        if tag not in HEAD:
            self.end({"head"}, {"body"})
        if tag in BLOCKS:
            self.end({"p"}, P_STOPS)
        if tag in ENDS:
            self.end(*ENDS[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.start("tr", "")
        if tag in ("td", "th", "tr", "thead", "tbody", "tfoot", "caption") and not self.inside["table"]:
            return  # a part of a table outside one
        node = Node(tag, attributes)
        self.add(node)
        if tag not in VOID:
            self.open.append(node)
            self.inside[tag] += 1

    def finish(self, tag: str) -> None:
        if tag == "br":
            self.add(Node("br"))
        elif tag not in ("html", "body") and not self.end({tag}, {"td", "th"} if tag not in TABLE_PARTS | {"td", "th"} else set()) and tag == "p":
            self.add(Node("p"))


def build(page: str) -> Node:
    tree, at, n = TreeBuilder(), 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        text = page[at:m.start() if m else n]
        if text:
            if text.strip(" \t\n\r\f"):
                tree.end({"head"}, set())
                tree.add(html.unescape(text))
            elif tree.open[-1].tag not in TABLE_PARTS:
                tree.add(text)
        if m is None:
            break
        at = m.end()
        if m[1]:
            tree.finish(m[1].lower())
        elif m[2] or m[4]:  # the latter with a quote that never closes
            tag = (m[2] or m[4]).lower()
            attributes = m[3] or m[5] or ""
            foreign = next((n.tag for n in reversed(tree.open) if n.tag in FOREIGN), None)
            tree.start(tag, attributes.removesuffix("/") + (" hidden" if foreign and tag in FOREIGN[foreign] else ""))
            if foreign and attributes.endswith("/") and tag not in RAW:
                tree.finish(tag)
                continue
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                inside = page[at:close.start() if close else n]
                if tag == "textarea":
                    tree.add(html.unescape(inside))
                elif tag == "xmp":
                    tree.add(inside)
                at = close.start() if close else n
                if not close:
                    tree.finish(tag)
    return tree.root


class Layout:
    """Lines of text with collapsed space, margins between blocks, indents and list marks."""

    def __init__(self):
        self.lines: list[str] = []
        self.words = ""
        self.margin = 0  # empty lines wanted before the next text
        self.indents: list[str] = []
        self.mark: str | None = None  # list mark of the next line

    def text(self, text: str, keep: bool) -> None:
        if keep:
            first, *rest = text.split("\n")
            self.words += first
            for line in rest:
                self.flush(True)
                self.words = line
            return
        text = _SPACE.sub(" ", text)
        self.words += text.lstrip(" ") if not self.words or self.words[-1] == " " else text

    def flush(self, even_empty: bool = False) -> None:
        line = self.words.rstrip(" ")
        self.words = ""
        if line or even_empty or self.mark:
            self.line(line)

    def line(self, line: str) -> None:
        if self.lines:
            self.lines += [""] * self.margin
        self.margin = 0
        indent = "".join(self.indents)
        if self.mark:
            indent, self.mark = indent[:len(indent) - len(self.mark)] + self.mark, None
        self.lines.append((indent + line).rstrip(" "))

    def block(self, spaced: bool) -> None:
        self.flush()
        if spaced and self.mark is None:
            self.margin = 1


def _span(cell: Node, name: str) -> int:
    value = re.match(r"\s*(\d{1,6})", cell.get(name) or "1")
    return min(max(int(value[1]) if value else 1, 1), MAX_SPAN)


def table_lines(table: Node, tables: int) -> list[str]:
    """Rows with every column as wide as its widest cell; cells that span rows or columns keep their place."""
    captions, rows, todo = [], [], [table]
    while todo:
        for child in (node := todo.pop()).children:
            if isinstance(child, Node) and child.visible():
                if child.tag == "tr":
                    rows.append([c for c in child.children if isinstance(c, Node) and c.tag in ("td", "th") and c.visible()])
                elif child.tag == "caption":
                    captions += render(child, tables)
                elif node is table:
                    todo.append(child)
        if node is table:
            todo.reverse()  # parts in the order of the page; rows of the table itself come first
    placed, taken = [], {}
    for cells in rows:
        column, line = 0, []
        taken = {c: left - 1 for c, left in taken.items() if left > 1}
        for cell in cells:
            while column in taken:
                column += 1
            wide = _span(cell, "colspan")
            high = _span(cell, "rowspan")
            line.append((column, wide, render(cell, tables)))
            if high > 1:
                taken |= dict.fromkeys(range(column, column + wide), high)
            column += wide
        placed.append(line)
    widths: dict[int, int] = {}
    for spanning in (False, True):
        for column, wide, lines in (c for row in placed for c in row if (c[1] > 1) == spanning):
            have = sum(w + 2 for w in map(widths.get, range(column, column + wide)) if w)
            need, last = max(map(len, lines), default=0) + 2, column + wide - 1
            if need > have:
                widths[last] = widths.get(last, 0) + need - have - (0 if widths.get(last) else 2)
    starts, at = {}, 0
    for column in range(max(widths, default=-1) + 1):
        starts[column] = at
        at += widths.get(column, 0) + 2 if widths.get(column, 0) else 0
    out = captions
    for row in placed:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            text = ""
            for column, _, lines in row:
                if k < len(lines):
                    text = text.ljust(starts[column]) + lines[k]
            out.append(text.rstrip(" "))
    return out


def render(node: Node, tables: int = 0) -> list[str]:
    """The visible lines of a node's content."""
    out = Layout()
    counters: list[int] = []
    todo: list[tuple[Node | str, str, bool]] = [(c, "open", False) for c in reversed(node.children)]
    while todo:
        item, step, keep = todo.pop()
        if isinstance(item, str):
            out.text(item, keep)
            continue
        tag = item.tag
        if step == "close":
            out.block(tag in SPACED and not (tag in LISTS and counters[1:]))
            if tag in LISTS:
                counters.pop()
            if tag in LISTS or tag == "li" or tag in ("blockquote", "dd"):
                out.mark = None if tag == "li" else out.mark
                if tag not in LISTS:
                    out.indents.pop()
            continue
        if not item.visible():
            continue
        if tag == "br":
            out.flush(True)
            continue
        children = item.children
        if tag == "table" and tables < MAX_TABLES:
            out.block(True)
            for line in table_lines(item, tables + 1):
                out.line(line)
            out.margin = 1
            continue
        if tag == "select":
            options, nodes = [], [item]
            while nodes:
                n = nodes.pop()
                options += [n] if n.tag == "option" else []
                nodes += [c for c in reversed(n.children) if isinstance(c, Node)]
            children = next((o.children for o in options if o.get("selected") is not None), options[0].children if options else [])
        if tag == "details" and item.get("open") is None:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        if tag in BLOCKS or tag in TABLE_PARTS or tag in ("td", "th", "caption"):
            out.block(tag in SPACED and not (tag in LISTS and counters))
            if tag == "hr":
                out.line("-" * 3)
                out.margin = 1
                continue
            if tag in LISTS:
                first = re.match(r"-?\d{1,9}", item.get("start") or "1")
                counters.append(int(first[0]) if first and tag == "ol" else (1 if tag == "ol" else -(10**10)))
            elif tag == "li":
                ordered = bool(counters) and counters[-1] > -(10**10)
                mark = f"{counters[-1]}. " if ordered else "- "
                if ordered:
                    counters[-1] += 1
                out.indents.append(" " * len(mark))
                out.mark = mark
            elif tag in ("blockquote", "dd"):
                out.indents.append("  ")
            todo.append((item, "close", keep))
        keep = keep or tag in ("pre", "textarea", "xmp")
        todo += [(c, "open", keep) for c in reversed(children)]
    out.flush()
    return out.lines


def visible_text(page: str | None) -> str | None:
    return None if page is None else "\n".join(render(build(page)))


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """page_id, text, n_chars and n_lines of every whole page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(texts, pa.string())], names=["page_id", "text"])

    found = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col(column).cast("string").alias("html")).mapInArrow(run, "page_id long, text string")
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n")))
    return found.select("page_id", "text", F.char_length("text").cast("long").alias("n_chars"), F.when(F.col("text").isNotNull(), lines).cast("long").alias("n_lines"))
