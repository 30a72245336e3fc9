"""Layout-aware rendering of HTML to text.

A tree builder reads tags in one linear pass, supplies implied end tags, and renders each element into its parent's flow as it
closes, so nesting depth costs no recursion. All visible text is emitted: blocks start lines of their own, paragraphs and
headings stand apart by a blank line, list items carry markers and nest by indentation, table cells are aligned in columns,
preformatted text keeps its spaces. What a browser doesn't show (head, scripts, templates, hidden elements) is left out.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import lean, prepare

# Fixed values of the HTML standard: elements by how they are laid out and closed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes datalist object audio video canvas".split())
#: What isn't drawn within an element of another language.
UNDRAWN = {"svg": frozenset("desc defs metadata symbol".split()), "math": frozenset("annotation annotation-xml".split())}
APART = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote ul ol dl menu table figure hr fieldset".split())
BLOCK = APART | frozenset("html body div section article aside nav header footer main address form li dt dd tr td th caption thead tbody tfoot details summary figcaption center dir hgroup search legend optgroup option".split())
#: A start tag on the left closes an open element on the right, unless one of BARRIERS[left] stands between.
CLOSES_P = BLOCK - frozenset("html body li dt dd tr td th caption thead tbody tfoot option optgroup".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th", "caption"}, "option": {"option"}, "optgroup": {"optgroup", "option"}, "body": {"head"}}
CLOSES |= {k: {"thead", "tbody", "tfoot", "tr", "td", "th", "caption"} for k in ("thead", "tbody", "tfoot")}
BARRIERS = {"li": {"ul", "ol", "menu", "table"}, "dt": {"dl", "table"}, "dd": {"dl", "table"}}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=|["'])*+)>""")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile("[ \t\n\r\f]+")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


class Flow:
    """Lines under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = False
        self.pre = 0

    def text(self, s: str) -> None:
        if self.pre:
            first, *rest = s.split("\n")
            self.inline.append(first)
            for line in rest:
                self.line(keep=True)
                self.inline.append(line)
        else:
            self.inline.append(s)

    def line(self, keep: bool = False) -> None:
        """End the line; an empty one only stays with keep."""
        joined = "".join(self.inline)
        self.inline = []
        self.put([joined.rstrip() if self.pre else _SPACE.sub(" ", joined).strip(" ")], keep)

    def put(self, lines: list[str], keep: bool = False) -> None:
        if keep or any(lines):
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines += lines

    def apart(self) -> None:
        self.line()
        self.gap = True

    def done(self) -> list[str]:
        self.line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class Node:
    __slots__ = ("tag", "flow", "hidden", "rows", "number", "down")

    def __init__(self, tag: str, flow: Flow, hidden: bool) -> None:
        self.tag, self.flow, self.hidden = tag, flow, hidden
        self.rows: list = []
        self.number = 0
        self.down = 1


def attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTR.findall(raw):
        found.setdefault(name.lower(), html.unescape(value[1:-1] if value[:1] in {'"', "'"} else value))
    return found


def is_hidden(attrs: dict[str, str]) -> bool:
    return "hidden" in attrs or ("style" in attrs and bool(_HIDING.search(attrs["style"]))) or attrs.get("type", "").lower() == "hidden"


def span_of(value: str, most: int) -> int:
    """A colspan or rowspan; 1 for what is none."""
    return min(int(value), most) if value.isdigit() and value.isascii() and len(value) < 7 else 1


def grid(rows: list[list[tuple[list[str], int, int]]]) -> list[list[list[str]]]:
    """Rows of cells (lines, columns, rows that they take) as columns: places that a cell reaches into stay empty."""
    out, down = [], {}  # column: how many more rows a cell from above takes
    for row in rows:
        line: list[list[str]] = []

        def pass_over(line=line) -> None:
            while down.get(len(line)):
                down[len(line)] -= 1
                line.append([])

        for lines, across, deep in row:
            pass_over()
            at = len(line)
            line += [lines] + [[]] * (across - 1)
            if deep > 1:
                down.update(dict.fromkeys(range(at, at + across), deep - 1))
        pass_over()
        for column in [c for c, left in down.items() if left and c >= len(line)]:
            down[column] -= 1
        out.append(line)
    return out


def table_lines(rows: list[list[list[str]]]) -> list[str]:
    """Rows of cells of lines, columns aligned and parted by " | "."""
    if not rows:
        return []
    columns = max(map(len, rows))
    width = [max((len(line) for row in rows if c < len(row) for line in row[c]), default=0) for c in range(columns)]
    out = []
    for row in rows:
        for k in range(max((len(cell) for cell in row), default=0)):
            cells = [(row[c][k] if c < len(row) and k < len(row[c]) else "").ljust(width[c]) for c in range(columns)]
            out.append(" | ".join(cells).rstrip())
    return out


class Builder:
    def __init__(self) -> None:
        self.stack = [Node("#root", Flow(), False)]
        #: By tag: where its open elements stand in the stack.
        self.open: dict[str, list[int]] = defaultdict(list)

    @property
    def top(self) -> Node:
        return self.stack[-1]

    def last(self, *tags: str) -> int:
        """The place of the innermost open element of tags; 0 for none."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def text(self, raw: str) -> None:
        if raw and not self.top.hidden:
            self.top.flow.text(html.unescape(raw) if "&" in raw else raw)

    def start(self, tag: str, raw: str) -> None:
        if len(self.stack) > 1:
            if tag in CLOSES:
                self._imply(CLOSES[tag], BARRIERS.get(tag, {"table"}))
            if tag in CLOSES_P and self.open.get("p"):
                self._imply({"p"}, {"table", "li", "td", "th", "blockquote", "dd"})
        attrs = attributes(raw) if raw and raw != "/" else {}
        parent = self.top
        foreign = [k for k in UNDRAWN if tag == k or self.open.get(k)]
        hidden = parent.hidden or tag in UNSEEN or any(tag in UNDRAWN[k] for k in foreign) or (bool(attrs) and is_hidden(attrs))
        if foreign and raw.rstrip().endswith("/"):
            return
        if tag in VOID:
            if not hidden:
                self._void(tag, attrs)
            return
        flow = parent.flow
        if not hidden and tag == "text" and foreign:
            flow.line()
        if not hidden and tag in BLOCK:
            if tag in APART and not (tag in {"ul", "ol", "menu"} and self.open.get("li")):
                flow.apart()
            else:
                flow.line()
        if tag in {"li", "td", "th", "blockquote", "dd"}:
            flow = Flow()
        node = Node(tag, flow, hidden)
        if tag == "ol" and attrs.get("start", "").lstrip("-").isdigit():
            node.number = int(attrs["start"][:9]) - 1
        if tag == "pre" and not hidden:
            flow.pre += 1
        if tag in {"td", "th"}:
            node.number, node.down = max(1, span_of(attrs.get("colspan", ""), 1000)), span_of(attrs.get("rowspan", ""), 65534) or 65534
        self.open[tag].append(len(self.stack))
        self.stack.append(node)

    def _void(self, tag: str, attrs: dict[str, str]) -> None:
        flow = self.top.flow
        if tag == "br":
            flow.line(keep=True)
        elif tag == "hr":
            flow.apart()
            flow.put(["---"])
            flow.apart()
        elif tag == "img" and attrs.get("alt", "").strip():
            flow.text(f" {attrs['alt']} ")
        elif tag == "input" and attrs.get("type", "text").lower() in {"submit", "button", "reset", "text"}:
            flow.text(f" {attrs.get('value', '')} ")
        elif tag == "wbr":
            flow.text("")

    def _imply(self, tags: set[str], barriers: set[str]) -> None:
        """Close all of tags that are open within the nearest barrier."""
        barrier = self.last(*barriers)
        places = [own[k] for t in tags if (own := self.open.get(t)) and (k := bisect_right(own, barrier)) < len(own)]
        if places:
            self._close_to(min(places))

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
        elif self.open.get(tag):
            k = self.open[tag][-1]
            if tag not in BLOCK and self.last("td", "th", "li", "table") > k:
                return  # a stray inline end tag doesn't tear a cell or an item
            self._close_to(k)
        elif tag == "p":
            self.top.flow.apart()

    def _close_to(self, k: int) -> None:
        while len(self.stack) > k:
            self._close(self.stack.pop())

    def _close(self, node: Node) -> None:
        tag = node.tag
        self.open[tag].pop()
        if node.hidden:
            return
        parent = self.top
        if tag == "pre":
            node.flow.line()
            node.flow.pre -= 1
        if tag == "li":
            holder = self.stack[self.last("ul", "ol", "menu")]
            if holder.tag == "ol":
                holder.number += 1
                mark = f"{holder.number}. "
            else:
                mark = "- "
            lines = node.flow.done()
            if lines:
                parent.flow.put([mark + lines[0], *(" " * len(mark) + x if x else "" for x in lines[1:])])
        elif tag in {"td", "th"}:
            row = self.stack[self.last("tr", "table")]
            if row.tag == "tr":
                row.rows.append((node.flow.done(), node.number, node.down))
            else:  # a cell without a row
                parent.flow.put(node.flow.done())
        elif tag == "tr":
            if k := self.last("table"):
                self.stack[k].rows.append(node.rows)
            else:
                parent.flow.put(table_lines(grid([node.rows])))
        elif tag == "table":
            parent.flow.line()
            parent.flow.put(table_lines(grid(node.rows)))
        elif tag == "blockquote":
            parent.flow.put([f"> {x}".rstrip() for x in node.flow.done()])
        elif tag == "dd":
            parent.flow.put([f"  {x}".rstrip() for x in node.flow.done()])
        if tag in APART and not (tag in {"ul", "ol", "menu"} and self.open.get("li")):
            parent.flow.apart()
        elif tag in BLOCK:
            parent.flow.line()

    def done(self) -> str:
        self._close_to(1)
        return "\n".join(self.top.flow.done())


def render(source: str | None) -> str:
    """The visible text of an HTML source, lines parted by newlines; empty for null or empty sources."""
    if not source:
        return ""
    source = source.replace("\r\n", "\n").replace("\0", "")
    made, at, n, last = Builder(), 0, len(source), source.rfind(">")
    while at < n:
        lt = source.find("<", at)
        if lt < 0 or (lt > last and not source.startswith("<!--", lt)):
            made.text(source[at:] if lt < 0 or not source[lt + 1 : lt + 2].isalpha() else source[at:lt])
            break
        if lt > at:
            made.text(source[at:lt])
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = n if end < 0 else end + 3
        elif source.startswith(("<!", "<?"), lt) or (source.startswith("</", lt) and not source[lt + 2 : lt + 3].isalpha()):
            at = source.find(">", lt) + 1 or n
        elif (m := _TAG.match(source, lt)) is not None:
            tag, at = m[2].lower(), m.end()
            if m[1]:
                made.end(tag)
            else:
                made.start(tag, m[3])
                if tag in RAW:
                    close = re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
                    stop = close.start() if close else n
                    if tag == "textarea":
                        made.text(source[at:stop])
                    at = (source.find(">", stop) + 1 or n) if close else n
                    made.end(tag)
        else:
            made.text("<")
            at = lt + 1
    return made.done()


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_lines, n_chars for each row of pages (page_id, url, html), row by row.

    Null or empty html gives an empty text. Other columns are ignored; null ids and urls stay null.
    """
    prepare(pages.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(source) for source in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_lines", "n_chars"])

    own = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return own.mapInArrow(lean(rows), "page_id bigint, url string, text string, n_lines bigint, n_chars bigint")
