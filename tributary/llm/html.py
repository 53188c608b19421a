"""Text of web pages, laid out as a reader sees it.

A tree is built from the tags (missing end tags are implied, stray ones
ignored), what a browser would not show is left out, and the rest is rendered:
blocks on lines of their own with their spacing, lists with bullets or numbers,
table cells in aligned columns, preformatted text as it is.  Formulas (MathML) and the
text elements of SVG show their text, a select its chosen option, a list box all of its options.

Limits: style sheets are not applied, only ``hidden`` and ``style`` attributes;
an element with ``visibility: hidden`` hides all that is in it; cells of more than
``WIDEST_COLUMN`` characters do not widen their column, and tables nested deeper
than ``DEEPEST_TABLE`` are laid out as blocks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|</([a-zA-Z][^\s/>]*+)[^>]*+>
    |<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""", re.S | re.X)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Matches what ``TOKEN`` can match where no ">" follows.
UNCLOSED = re.compile(r"<!--.*", re.S)
SPACE = re.compile(r"[ \t\r\n\f]+")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)

# What the language of web pages says of its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
HIDDEN = frozenset("head script style title template noscript iframe noembed noframes object audio video canvas datalist".split())
#: Elements that are not shown inside svg and math, those whose content is HTML again, and HTML elements that end an open svg or math.
HIDDEN_IN = {"svg": frozenset("title desc defs metadata symbol clippath mask pattern marker".split()), "math": frozenset("annotation annotation-xml mphantom".split())}
HTML_AGAIN = frozenset("foreignobject annotation-xml mi mo mn ms mtext".split())
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s "
                       "small span strong strike sub sup table tt u ul var".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset address hr xmp".split())
BLOCK = SPACED | frozenset("html body div section article aside header footer main nav form li dt dd details summary figcaption legend "
                           "dialog menu center tr td th thead tbody tfoot caption option search hgroup".split())
#: A start tag of the key ends an open element of these, inside the nearest of the barriers.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
        "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "option": ({"option"}, {"select"}), "optgroup": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
ENDS_PARAGRAPH = BLOCK - {"li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "option", "html", "body", "legend", "summary"} | {"li", "dt", "dd"}
CELL_BARRIERS = frozenset({"td", "th", "caption", "table"})
#: Wider cells do not widen their column; tables nested deeper than this are plain blocks.
WIDEST_COLUMN, DEEPEST_TABLE = 60, 20


@dataclass
class Node:
    tag: str
    attributes: str = ""
    children: list = field(default_factory=list)
    inside: str = ""  # svg or math

    def attribute(self, name: str) -> str | None:
        if name not in self.attributes.lower():
            return None
        for key, value in ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return unescape(value[1:-1] if value[:1] in ('"', "'") else value)
        return None

    def hidden(self) -> bool:
        if self.tag in HIDDEN or (self.tag == "dialog" and self.attribute("open") is None):
            return True
        if self.inside and self.tag in HIDDEN_IN[self.inside]:
            return True
        if self.inside == "svg" and ((self.attribute("display") or "").strip() == "none" or (self.attribute("visibility") or "").strip() in ("hidden", "collapse")):
            return True
        return bool(self.attributes) and (self.attribute("hidden") is not None or bool(HIDING.search(self.attribute("style") or "")))


def within(parent: Node) -> str:
    """Whether children of ``parent`` are svg's, math's or (empty) HTML's."""
    return parent.tag if parent.tag in HIDDEN_IN else "" if parent.tag in HTML_AGAIN else parent.inside


def shown(node: Node) -> list:
    """What an element shows: its children; of svg the texts, of select the
    chosen option (the last selected one, else the first that can be chosen)."""
    if node.tag not in ("svg", "select"):
        return node.children
    found, todo = [], list(reversed(node.children))
    while todo:
        n = todo.pop()
        if isinstance(n, str) or n.hidden():
            continue
        if n.tag in (("text", "foreignobject") if node.tag == "svg" else ("option",)):
            found.append(n)
        else:
            todo.extend(reversed(n.children))
    if node.tag == "select":
        size = (node.attribute("size") or "").strip()
        if node.attribute("multiple") is None and not (size.isdecimal() and int(size) > 1):
            chosen = [n for n in found if n.attribute("selected") is not None]
            found = chosen[-1:] or [n for n in found if n.attribute("disabled") is None][:1]
        found = [n.attribute("label") or text_of(n) for n in found]
    return [" ", *(x for n in found for x in (n, " "))]


def build_tree(html: str) -> Node:
    root = Node("html")
    stack, at, last = [root], 0, html.rfind(">")
    places: dict[str, list[int]] = {}  # where in the stack the open elements of a tag are

    def cut(depth: int) -> None:
        while len(stack) > depth:
            places[stack.pop().tag].pop()

    def nearest(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(tags, barriers) -> None:
        depth = nearest(tags)
        if depth and depth >= nearest(barriers):
            cut(depth)

    while at < len(html):
        # after the last ">" only an unclosed comment can be a token
        m = TOKEN.search(html, at) if at <= last else UNCLOSED.search(html, at)
        text = html[at:m.start() if m else len(html)]
        if text:
            if stack[-1].tag == "head" and text.strip():
                cut(len(stack) - 1)  # text ends the head
            stack[-1].children.append(unescape(text) if "&" in text else text)
        if m is None or at > last:
            break
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag == "br":
                stack[-1].children.append(Node("br"))
            elif tag not in ("html", "body"):
                close({tag}, () if tag in ("table", "head") else CELL_BARRIERS - {tag} if tag not in ("tr", "thead", "tbody", "tfoot") else {"table"})
        elif m[2]:
            tag = m[2].lower()
            if tag == "html":
                continue
            if tag in BREAKS_OUT:
                while within(stack[-1]):
                    cut(len(stack) - 1)
            if stack[-1].tag == "head" and tag in BLOCK:
                cut(len(stack) - 1)
            if tag == "select":  # ends an open one
                close({"select"}, ())
            if tag in ENDS:
                close(*ENDS[tag])
            if tag in ENDS_PARAGRAPH:
                close({"p"}, CELL_BARRIERS | {"li", "dd", "dt"} if tag not in ("li", "dt", "dd") else CELL_BARRIERS | {"ul", "ol", "dl"})
            node = Node(tag, m[3] or "", inside=within(stack[-1]))
            stack[-1].children.append(node)
            if tag in VOID or (node.inside and node.attributes.endswith("/")):
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
                node.children.append(html[at:end.start() if end else len(html)])
                at = end.end() if end else len(html)
            elif not (m[3] or "").endswith("/") or tag not in ("svg", "math"):
                places.setdefault(tag, []).append(len(stack))
                stack.append(node)
    return root


class Lines:
    """Text laid out so far: finished lines and the one that is being filled."""

    def __init__(self):
        self.done: list[str] = []
        self.parts: list[str] = []
        self.gap = False           # a blank line is due before the next text
        self.first = self.rest = ""  # indents of the next line and those after it

    def text(self, s: str) -> None:
        s = SPACE.sub(" ", s)
        if not self.parts or self.parts[-1].endswith((" ", "\n")):
            s = s.lstrip(" ")
        if s:
            self.parts.append(s)

    def end_line(self, keep_empty: bool = False) -> None:
        line = "".join(self.parts).rstrip(" ")
        self.parts = []
        if line or keep_empty:
            self.add(line)

    def add(self, line: str) -> None:
        if self.gap and self.done and line:
            self.done.append("")
        self.gap = self.gap and not line
        self.done.append((self.first + line).rstrip())
        self.first = self.rest

    def space(self) -> None:
        self.end_line()
        self.gap = True


def rows_of(table: Node) -> tuple[list[Node], list[Node]]:
    """Captions and rows of a table, in order; nested tables keep theirs."""
    captions, rows, todo = [], [], list(reversed(table.children))
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            if n.strip():
                captions.append(Node("caption", "", [n]))
        elif not n.hidden():
            if n.tag == "tr":
                rows.append(n)
            elif n.tag in ("thead", "tbody", "tfoot"):
                todo.extend(reversed(n.children))
            elif n.tag in ("td", "th"):
                rows.append(Node("tr", "", [n]))
            elif n.tag not in ("colgroup", "col"):
                captions.append(n if n.tag == "caption" else Node("caption", "", [n]))
    return captions, rows


def table_lines(table: Node, depth: int) -> list[str]:
    captions, rows = rows_of(table)
    grid: list[list[tuple[int, int, list[str]]]] = []  # (column, columns, lines)
    below: dict[int, int] = {}                          # column -> rows still covered from above
    for row in rows:
        cells, col = [], 0
        loose = [c for c in row.children if isinstance(c, str) and c.strip() or isinstance(c, Node) and c.tag not in ("td", "th")]
        if loose:
            captions.append(Node("caption", "", loose))
        for c in row.children:
            if isinstance(c, Node) and c.tag in ("td", "th") and not c.hidden():
                while below.get(col, 0):
                    col += 1
                span, high = (min(1000, max(1, int(v))) if (v := (c.attribute(a) or "").strip()).isdecimal() else 1 for a in ("colspan", "rowspan"))
                cells.append((col, span, layout(c.children, depth + 1)))
                for k in range(col, col + span):
                    below[k] = high
                col += span
        below = {k: n - 1 for k, n in below.items() if n > 1}
        grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        for col, span, lines in cells:
            if span == 1:
                widths[col] = max(widths.get(col, 0), *(len(x) for x in lines if len(x) <= WIDEST_COLUMN), 0)
    columns = sorted({col for cells in grid for col, _, lines in cells if lines})
    starts, x = {}, 0
    for col in columns:
        starts[col] = x
        x += widths.get(col, 0) + 2
    out = [line for c in captions for line in layout(c.children, depth + 1)]
    for cells in grid:
        for k in range(max((len(lines) for _, _, lines in cells), default=0)):
            line = ""
            for col, _, lines in cells:
                if k < len(lines) and lines[k]:
                    line = line.ljust(starts[col]) if len(line) < starts[col] or not line else line + "  "
                    line += lines[k]
            out.append(line.rstrip())
    return out


def layout(children: list, depth: int = 0) -> list[str]:
    """Lines of what the nodes show."""
    out = Lines()
    lists: list[list] = []  # [numbered, next number, indent outside] of the open lists
    todo: list = [("node", c) for c in reversed(children)]
    while todo:
        what, n = todo.pop()
        if what == "end":
            n()
        elif isinstance(n, str):
            out.text(n)
        elif n.hidden():
            continue
        elif n.tag == "br":
            out.end_line(keep_empty=True)
        elif n.tag == "hr":
            out.space()
            out.add("----")
            out.gap = True
        elif n.tag in ("pre", "xmp", "textarea"):
            out.space()
            for line in text_of(n).removeprefix("\n").rstrip("\n").split("\n"):
                out.add(line.rstrip("\r"))
            out.gap = True
        elif n.tag == "table" and depth < DEEPEST_TABLE:
            out.space()
            for line in table_lines(n, depth):
                out.add(line)
            out.gap = True
        elif n.tag in BLOCK:
            spaced = n.tag in SPACED and not (n.tag in ("ul", "ol", "dl") and lists)
            (out.space if spaced else out.end_line)()
            old = out.first, out.rest
            if n.tag in ("ul", "ol", "menu"):
                start = (n.attribute("start") or "").strip()
                lists.append([n.tag == "ol", int(start) if start.lstrip("-").isdecimal() else 1])
            elif n.tag == "li":
                mark = "- "
                if lists and lists[-1][0]:
                    value = (n.attribute("value") or "").strip()
                    lists[-1][1] = int(value) if value.lstrip("-").isdecimal() else lists[-1][1]
                    mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                out.first, out.rest = out.rest + mark, out.rest + " " * len(mark)
            elif n.tag in ("dd", "blockquote"):
                out.first = out.rest = out.rest + "    "

            def end(tag=n.tag, spaced=spaced, old=old):
                (out.space if spaced else out.end_line)()
                if tag in ("ul", "ol", "menu"):
                    lists.pop()
                elif tag in ("li", "dd", "blockquote"):
                    out.first, out.rest = old[1], old[1]

            todo.append(("end", end))
            inner = n.children
            if n.tag == "details" and n.attribute("open") is None:  # closed: its summary only
                inner = [c for c in inner if isinstance(c, Node) and c.tag == "summary"][:1]
            todo.extend(("node", c) for c in reversed(inner))
        else:
            todo.extend(("node", c) for c in reversed(shown(n)))
    out.end_line()
    return out.done


def text_of(node: Node) -> str:
    """All shown text below a node, white space kept."""
    parts, todo = [], list(reversed(node.children))
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            parts.append(n)
        elif n.tag == "br":
            parts.append("\n")
        elif not n.hidden():
            todo.extend(reversed(shown(n)))
    return "".join(parts)


def render(html: str) -> str:
    return "\n".join(layout(build_tree(html.replace("\r\n", "\n").replace("\0", "")).children)).strip("\n")


def extract(pages: DataFrame, column: str = "html", out: str = "text") -> DataFrame:
    """All columns of pages but ``column``, and the rendered text as ``out``.

    Null html stays null, empty html is empty text; broken markup is read as
    far as it goes; repeated rows are kept; an empty table stays empty.  A
    column that is already called ``out`` is replaced.
    """
    kept = [c for c in pages.columns if c not in (column, out)]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [None if h is None else render(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "text"])

    schema = T.StructType([*(T.StructField(f"c{i}", pages.schema[c].dataType) for i, c in enumerate(kept)), T.StructField("text", T.StringType())])
    sent = pages.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(f"`{column}`").alias("text"))
    return sent.mapInArrow(run, schema).toDF(*kept, out)
