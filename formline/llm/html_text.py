"""Visible text of HTML pages, laid out as text.

A tree builder with implied start and end tags keeps the open elements; a renderer works as elements
open and close, so depth costs no recursion. All visible text comes out, in order: white space is
collapsed outside ``pre``; blocks stand on lines of their own, paragraphs, headings, lists and tables between
blank lines; list items have bullets or numbers and are indented by level; quotations are indented; table
cells stand in columns of equal width. Formulas are read in order, the parts of fractions and scripts apart;
of drawings the labels come out (``extract`` does so, ``visible_text`` on request).

Not visible are: what is never rendered (head matter other than the title, which is returned by itself,
scripts, styles, templates, frames, media fall-backs); elements that the page's style sheets and style
attributes give ``display: none`` or ``visibility: hidden`` on a screen, by the cascade (see
:mod:`formline.llm.style_rules`), or that have ``hidden`` and are given no other display; closed ``details`` but for
their summary; closed ``dialog``; annotations of formulas; titles, descriptions and definitions of drawings, except
where the drawing uses these.

Defined cases: a null or empty page gives an empty title and text; text without any tag is a paragraph;
unclosed, misnested or cut-off markup is repaired as the implied end tags allow; rows with a null id and
repeated rows are rendered like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.style_rules import Node, Sheets

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
UNSEEN = frozenset(
    "head script style template noscript iframe noembed noframes title audio video canvas object "
    "datalist area base link meta param source track map".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol menu dir dl pre table figure fieldset hr xmp".split())
LINES = frozenset(
    "html body div section article aside header footer nav main address form center details summary dialog "
    "figcaption legend hgroup search dt dd li option optgroup caption textarea".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul dd dt".split()
)
HEAD_ONLY = frozenset("title base link meta style script noscript template head html".split())
#: Never rendered inside a formula or a drawing; what holds HTML there; HTML tags that end both.
MATH_UNSEEN = frozenset("annotation annotation-xml mphantom".split())
SVG_UNSEEN = frozenset("defs title desc metadata symbol clippath mask pattern marker".split())
HOLDS_HTML = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: What a drawing shows text in.
SVG_TEXT = frozenset({"text", "foreignobject"})
#: Children of these formula parts stand apart.
MATH_APART = frozenset("mfrac msup msub msubsup munder mover munderover mroot mmultiscripts mtr".split())
#: Which open elements a start tag ends, and the elements beyond which it does not look.
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "tbody": ({"td", "th", "tr", "caption", "colgroup", "tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"td", "th", "tr", "caption", "colgroup", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "caption", "colgroup", "tbody", "thead", "tfoot"}, {"table"}),
}
#: End tags do not look beyond these, unless they name one of them or something around them.
WALLS = frozenset({"table", "td", "th", "caption"})
TABLE_PARTS = frozenset({"tr", "td", "th", "tbody", "thead", "tfoot", "caption"})
#: Columns are padded up to this width; wider cells stand out.
MAX_COLUMN = 60
MAX_SPAN = 1000

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|</([a-zA-Z][^\s/>]*)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
#: Uses of definitions inside definitions that a drawing follows.
MAX_USES = 8


@dataclass
class Flow:
    """Lines of one block container; ``prefix`` marks the first line of a list item."""

    prefix: str = ""
    lines: list[str] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    gap: int = -1  # blank lines owed before the next line; -1 before the first
    spaced: bool = True  # the line so far is empty or ends in collapsed white space

    def text(self, value: str, keep: bool) -> None:
        if keep:
            first, *rest = value.replace("\r\n", "\n").split("\n")
            for i, line in enumerate([first, *rest]):
                if i:
                    self.end_line(empty=True)
                if line:
                    self.parts.append(line)
                    self.spaced = False
            return
        value = _SPACE.sub(" ", value)
        if self.spaced:
            value = value.removeprefix(" ")
        if value:
            self.parts.append(value)
            self.spaced = value.endswith(" ")

    def end_line(self, empty: bool = False) -> None:
        line = "".join(self.parts).rstrip(" ")
        self.parts.clear()
        self.spaced = True
        if line or empty:
            self.add([line])

    def add(self, lines: list[str]) -> None:
        if self.gap > 0:
            self.lines += [""] * self.gap
        self.gap = 0
        self.lines += lines

    def break_(self, gap: int) -> None:
        self.end_line()
        if self.gap >= 0:
            self.gap = max(self.gap, gap)

    def finished(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


@dataclass
class Table:
    """Cells placed by row and column; each is (column, span, lines)."""

    rows: list[list[tuple[int, int, list[str]]]] = field(default_factory=list)
    taken: dict[int, int] = field(default_factory=dict)  # column: rows below that a cell reaches into
    column: int = 0

    def row(self) -> None:
        self.rows.append([])
        self.column = 0
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.fresh: dict[int, int] = {}

    def cell(self, lines: list[str], span: int, down: int) -> None:
        if not self.rows:
            self.row()
        while self.column in self.taken:
            self.column += 1
        self.rows[-1].append((self.column, span, lines))
        for c in range(self.column, self.column + span):
            if down > 1:
                self.fresh[c] = down
        self.column += span

    def end_row(self) -> None:
        if self.rows:
            self.taken |= self.fresh
            self.fresh = {}

    def laid_out(self) -> list[str]:
        widths: dict[int, int] = {}
        for row in self.rows:
            for column, span, lines in row:
                if span == 1:
                    width = max(map(len, lines), default=0)
                    widths[column] = max(widths.get(column, 0), min(width, MAX_COLUMN))
        for row in self.rows:  # a cell over several columns widens the last of them
            for column, span, lines in row:
                if span > 1:
                    wanted = min(max(map(len, lines), default=0), MAX_COLUMN)
                    there = sum(widths.get(c, 0) + 2 for c in range(column, column + span)) - 2
                    widths[column + span - 1] = widths.get(column + span - 1, 0) + max(0, wanted - there)
        starts, at = {}, 0
        for column in range(max((c + s for row in self.rows for c, s, _ in row), default=0)):
            starts[column] = at
            if widths.get(column):
                at += widths[column] + 2
        out = []
        for row in self.rows:
            for k in range(max((len(lines) for _, _, lines in row), default=0)):
                line = ""
                for column, _, lines in row:
                    if k < len(lines) and lines[k]:
                        line = line.ljust(starts[column])
                        line += ("  " if line and not line.endswith("  ") else "") + lines[k]
                out.append(line.rstrip())
        return [line for line in out if line]


@dataclass
class Element:
    tag: str
    gone: bool
    hidden: bool
    pre: bool
    flow: Flow | None = None
    table: Table | None = None
    spans: tuple[int, int] = (1, 1)
    count: int = 0
    folded: bool = False
    node: Node | None = None


class Page:
    """Builds and renders one page."""

    def __init__(self, drawings: bool = False) -> None:
        self.drawings = drawings
        self.root = Element("", False, False, False, Flow(), node=Node("", {}))
        self.open = [self.root]
        self.nodes: list[Node] = []  # those of the open elements but the root
        self.flows = [self.root.flow]
        self.tables: list[Element] = []
        self.counts: Counter = Counter()
        self.title = ""
        self.sheets = Sheets()
        self.html = ""
        self.uses: list[str] = []

    # text and tags

    def run(self, html: str) -> tuple[str, str]:
        self.html = html
        if "<style" in html or "<STYLE" in html or "<Style" in html:
            self.read_sheets(html)
        self.feed(html)
        while len(self.open) > 1:
            self.pop()
        return self.title, "\n".join(self.root.flow.finished()).replace("\xa0", " ")

    def read_sheets(self, html: str) -> None:
        """All sheets of the page, which hold for what stands before them too."""
        at = 0
        while (found := _TOKEN.search(html, at)) is not None:
            at = found.end()
            tag = (found[2] or found[4] or "").lower()
            if tag == "plaintext":
                break
            if tag in RAW:
                close = _closing(tag).search(html, at)
                if tag == "style":
                    media = self.attributes(found[3] or found[5] or "").get("media", "")
                    self.sheets.add(html[at : close.start() if close else len(html)], media)
                at = close.end() if close else len(html)

    def feed(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            found = _TOKEN.search(html, at)
            if found is None:
                self.text(html[at:])
                break
            if found.start() > at:
                self.text(html[at : found.start()])
            at = found.end()
            end, start, attributes = found[1], found[2] or found[4], found[3] or found[5]
            if end:
                self.end(end.lower())
            elif start:
                tag = start.lower()
                self.start(tag, attributes)
                if (attributes or "").endswith("/") and (tag in ("svg", "math") or self.foreign()):
                    if self.open[-1].tag == tag:
                        self.pop()
                elif tag == "plaintext":
                    self.text(html[at:].replace("&", "&amp;"))
                    break
                elif tag in RAW:
                    close = _closing(tag).search(html, at)
                    raw = html[at : close.start() if close else n]
                    at = close.end() if close else n
                    self.raw(tag, raw)

    def raw(self, tag: str, text: str) -> None:
        top = self.open[-1]
        if tag == "title" and not self.title and not self.counts["svg"]:
            self.title = _SPACE.sub(" ", unescape(text)).strip()
        elif tag in ("textarea", "xmp") and not (top.gone or top.hidden):
            self.flows[-1].text(unescape(text) if tag == "textarea" else text, keep=True)
        if top.tag == tag:
            self.pop()

    def used(self, target: str) -> None:
        """Draws the definition that a drawing uses, once per chain of uses."""
        if target in self.uses or len(self.uses) >= MAX_USES:
            return
        mark = re.escape(target)
        found = re.search(rf"<([a-zA-Z][^\s/>]*)(?=[^>]*?\sid\s*=\s*(?:\"{mark}\"|'{mark}'|{mark}[\s/>]))[^>]*>", self.html)
        if found is None or found[0].endswith("/>"):
            return
        tag, depth, end = found[1], 1, len(self.html)
        for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*?(/?)>", self.html[found.end() :], re.IGNORECASE):
            depth += -1 if m[1] else 0 if m[2] else 1
            if not depth:
                end = found.end() + (m.start() if tag.lower() == "symbol" else m.end())
                break
        self.uses.append(target)
        open_before = len(self.open)
        hidden_parts = {t: self.counts.pop(t, 0) for t in SVG_UNSEEN}
        self.feed(self.html[found.end() if tag.lower() == "symbol" else found.start() : end])
        while len(self.open) > open_before:
            self.pop()
        self.counts.update(hidden_parts)
        self.uses.pop()

    def foreign(self) -> bool:
        """Whether a start tag is read as part of a formula or drawing."""
        counts = self.counts
        return bool(counts["svg"] or counts["math"]) and not any(counts[t] for t in HOLDS_HTML)

    def text(self, value: str) -> None:
        top = self.open[-1]
        if top.tag == "head" and value.strip(" \t\n\r\f"):
            self.close({"head"}, set())
            top = self.open[-1]
        if top.gone or top.hidden:
            return
        if self.counts["svg"] and not any(self.counts[t] for t in SVG_TEXT):
            return
        if "&" in value:
            value = unescape(value)
        flow = self.flows[-1]
        if top.tag in ("table", "tr", "tbody", "thead", "tfoot") and self.tables:
            if not value.strip():
                return
            # text between cells stands before the table
            outer = self.tables[-1]
            flow = outer.flow if outer.flow is not None else flow
        if top.folded:
            return
        flow.text(value, top.pre)

    def start(self, tag: str, raw: str) -> None:
        if tag in ENDS_FOREIGN and self.foreign():
            self.close({"svg", "math"}, set(), all_=True)
        if tag in ENDS_P and self.counts["p"]:
            self.close({"p"}, WALLS | {"button"})
        if tag in IMPLIED_ENDS:
            ended, border = IMPLIED_ENDS[tag]
            if any(self.counts[t] for t in ended):
                self.close(ended, border, all_=True)
        if tag not in HEAD_ONLY and self.counts["head"]:
            self.close({"head"}, set())
        if tag in ("html", "body") and self.counts[tag]:
            return
        attributes = self.attributes(raw) if raw and raw.strip(" /\n\t") else {}
        parent = self.open[-1]
        if tag in TABLE_PARTS and not self.tables:
            tag = "div"  # parts of no table
        keeps = parent.pre or tag in ("pre", "xmp", "textarea")
        node = Node(tag, attributes)
        if self.sheets.siblings and parent.node is not None:
            node.family, node.place = parent.node.children, len(parent.node.children)
            node.family.append(node)
        element = Element(tag, *self.visibility(tag, node, parent), keeps or tag == "plaintext", node=node)
        apart = tag in SVG_TEXT and self.counts["svg"] or parent.tag in MATH_APART
        if apart and not (element.gone or element.hidden):
            self.flows[-1].text(" ", keep=False)
        if tag == "use" and self.drawings and self.counts["svg"] and not (element.gone or element.hidden):
            target = attributes.get("href", attributes.get("xlink:href", ""))
            if target.startswith("#") and len(target) > 1:
                self.used(target[1:])
        if tag == "br":
            if not (element.gone or element.hidden):
                self.flows[-1].end_line(empty=True)
            return
        if tag in VOID:
            if tag == "hr":
                self.flows[-1].break_(1)
            return
        if tag == "table":
            element.table, element.flow = Table(), self.flows[-1]
            if not element.gone:
                self.flows[-1].break_(1)
            self.tables.append(element)
        elif tag == "tr":
            self.tables[-1].table.row()
        elif tag in ("td", "th", "caption", "li", "blockquote", "dd"):
            if tag in ("td", "th"):
                element.spans = tuple(self.number(attributes.get(k), 1, 1) for k in ("colspan", "rowspan"))
                if not self.tables[-1].table.rows:
                    self.tables[-1].table.row()
            elif not element.gone and tag != "caption":
                self.flows[-1].break_(1 if tag == "blockquote" else 0)
            element.flow = Flow(prefix=self.bullet(element, attributes) if tag == "li" else "")
            self.flows.append(element.flow)
        elif (tag in SPACED or tag in LINES) and not element.gone:
            nested = tag in ("ul", "ol", "menu", "dir") and self.counts["li"]
            self.flows[-1].break_(1 if tag in SPACED and not nested else 0)
        if tag == "details" and "open" not in attributes:
            element.folded = True
        if tag == "ol":
            element.count = self.number(attributes.get("start"), 1, None) - 1
        self.open.append(element)
        self.nodes.append(node)
        self.counts[tag] += 1

    def end(self, tag: str) -> None:
        if tag == "br":
            return self.start("br", "")
        if not self.counts[tag]:
            if tag == "p":
                self.flows[-1].break_(1)
            return None
        self.close({tag}, set() if tag in WALLS | TABLE_PARTS else WALLS)
        return None

    def close(self, tags: set[str], border: set[str] | frozenset[str], all_: bool = False) -> None:
        """Pops up to the nearest (``all_``: the furthest) open element of ``tags`` before the border."""
        depth = 0
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                depth = i
                if not all_:
                    break
            if tag in border:
                break
        while depth and len(self.open) > depth:
            self.pop()

    def pop(self) -> None:
        element = self.open.pop()
        self.nodes.pop()
        tag = element.tag
        self.counts[tag] -= 1
        apart = tag in SVG_TEXT and self.counts["svg"] or tag in MATH_APART
        if apart and not (element.gone or element.hidden):
            self.flows[-1].text(" ", keep=False)
        if element.table is not None:
            self.tables.pop()
            if not element.gone:
                element.flow.break_(1)
                lines = element.table.laid_out()
                if lines:
                    element.flow.add(lines)
                    element.flow.break_(1)
        elif element.flow is not None:
            self.flows.pop()
            lines = [] if element.gone else element.flow.finished()
            if tag in ("td", "th"):
                if not element.gone:
                    self.tables[-1].table.cell(lines, *element.spans)
            elif lines:
                self.nest(tag, element, lines)
        elif tag == "tr":
            if self.tables:
                self.tables[-1].table.end_row()
        elif (tag in SPACED or tag in LINES) and not element.gone:
            nested = tag in ("ul", "ol", "menu", "dir") and self.counts["li"]
            self.flows[-1].break_(1 if tag in SPACED and not nested else 0)

    def nest(self, tag: str, element: Element, lines: list[str]) -> None:
        """Puts a finished container's lines into the one around it."""
        outer = self.tables[-1].flow if tag == "caption" and self.tables else self.flows[-1]
        first = element.flow.prefix if tag == "li" else "" if tag == "caption" else "  "
        rest = " " * len(first)
        gap = 1 if tag == "blockquote" else 0
        outer.break_(gap)
        outer.add([(first if i == 0 else rest) + line if line else "" for i, line in enumerate(lines)])
        outer.break_(gap)

    # attributes

    @staticmethod
    def attributes(raw: str) -> dict[str, str]:
        out: dict[str, str] = {}
        for name, double, single, bare in _ATTRIBUTE.findall(raw):
            value = double or single or bare
            out.setdefault(name.lower(), unescape(value) if "&" in value else value)
        return out

    @staticmethod
    def number(value: str | None, default: int, least: int | None) -> int:
        found = re.match(r"\s*([+-]?\d{1,9})", value or "")
        if not found:
            return default
        n = int(found[1])
        return n if least is None else min(max(n, least), MAX_SPAN)

    def bullet(self, element: Element, attributes: dict[str, str]) -> str:
        for outer in reversed(self.open):
            if outer.tag in ("ul", "menu", "dir") or outer.flow is not None:
                break
            if outer.tag == "ol":
                outer.count = self.number(attributes.get("value"), outer.count + 1, None)
                return f"{outer.count}. "
        return "- "

    def visibility(self, tag: str, node: Node, parent: Element) -> tuple[bool, bool]:
        """Whether an element takes no part in the layout, and whether its text is invisible."""
        attributes = node.attributes
        gone = parent.gone or tag in UNSEEN or parent.folded and tag != "summary"
        hidden = parent.hidden
        if not gone:
            gone = (
                tag == "svg" and not self.drawings
                or tag in SVG_UNSEEN and self.counts["svg"] > 0
                or tag in MATH_UNSEEN and self.counts["math"] > 0
                or tag == "input" and attributes.get("type", "").lower() == "hidden"
            )
        if gone:
            return True, hidden
        told: dict[str, str] = {}
        if self.sheets.by_key or "style" in attributes:
            told = self.sheets.told(node, self.nodes, attributes.get("style", ""))
        if "display" in told:
            gone = told["display"] == "none"
        else:
            gone = "hidden" in attributes or tag == "dialog" and "open" not in attributes
        seen = told.get("visibility", "inherit")
        if seen in ("hidden", "collapse"):
            hidden = True
        elif seen in ("visible", "initial"):
            hidden = False
        return gone, hidden


@cache
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.IGNORECASE)


def visible_text(html: str | None, drawings: bool = False) -> tuple[str, str]:
    """Title and laid-out visible text of a page, with or without the labels of SVG drawings."""
    return Page(drawings).run(html) if html else ("", "")


def extract(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", drawings: bool = True
) -> DataFrame:
    """Per row: id, ``title``, ``text`` and ``n_chars`` of the text. Rows are not moved."""
    source = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [visible_text(h.as_py(), drawings) for h in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([t for t, _ in found], pa.string()),
                        pa.array([t for _, t in found], pa.string()),
                        pa.array([len(t) for _, t in found], pa.int64()),
                    ],
                    ["id", "title", "text", "n_chars"],
                )

    fields = f"id {source.schema['id'].dataType.simpleString()}, title string, text string, n_chars bigint"
    return source.mapInArrow(tasks, fields).select(F.col("id").alias(id_col), "title", "text", "n_chars")
