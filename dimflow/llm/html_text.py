"""Visible text of HTML pages, laid out.

A small tree builder supplies what HTML implies: void elements, end tags left out (p, li, dt, dd, option,
rows and cells and sections of tables), end tags that close what is open within them, and stray end tags that are
ignored. Then the tree is rendered: invisible elements are left out (scripts, styles, templates, the
head, `hidden`, `display:none`, closed details and dialogs), and so is text whose `visibility` is hidden, which
elements inherit and can undo (rules of style sheets are not read, only `style` attributes); white space
collapses but in preformatted text; blocks start new lines, and paragraphs, headings, lists, tables and quotes stand
apart by a blank line; list items get bullets or numbers and nest by indentation; the cells of a table are
aligned in columns, with their spans. All visible text comes out, in document order.

Each page is rendered on its own, without recursion, in time linear in its length.

Defined cases: null HTML gives a null text; empty HTML, or a page without visible text, an empty one. A column of a table
that has columns to its right is WIDEST wide at most: longer lines are wrapped at spaces, and a longer word stands whole, with the
cells to its right below it. Of a drawing (svg) the text elements and foreign objects are visible, but not in its definitions. Markup that is cut off is read as far as it
goes. Repeated rows are rendered each. Columns other than the two named do not matter.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters up to which a column of a table is padded.
WIDEST = 60
MOST_SPAN = 100

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
INVISIBLE = frozenset(
    "head script style template noscript iframe noembed noframes object canvas audio video datalist param title".split()
)
#: In a drawing: elements whose text is shown, and those that are not shown.
SVG_TEXT = frozenset(("text", "foreignobject"))
SVG_UNSEEN = frozenset("defs symbol desc metadata clippath mask pattern marker lineargradient radialgradient filter".split())
BLOCKS = frozenset(
    """address article aside body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary
    table tbody td tfoot th thead tr ul blockquote xmp""".split()
)
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl table pre xmp blockquote figure fieldset hr".split())
LISTS = frozenset("ul ol menu dir".split())
CELLS = frozenset(("td", "th"))
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
#: Start tag: open elements that it closes, and those beyond which it does not look.
CLOSES = {
    "li": ({"li"}, LISTS | {"table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": (CELLS | {"caption"}, {"table", "tr"}),
    "th": (CELLS | {"caption"}, {"table", "tr"}),
    "tr": (CELLS | {"tr", "caption"}, {"table"}),
    "thead": (CELLS | SECTIONS | {"tr", "caption"}, {"table"}),
    "tbody": (CELLS | SECTIONS | {"tr", "caption"}, {"table"}),
    "tfoot": (CELLS | SECTIONS | {"tr", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
CLOSES_P = (BLOCKS - {"caption", "html", "body", "legend", "option", "optgroup", "summary"} - CELLS - SECTIONS) - {"tr"}
P_SCOPE = frozenset({"td", "th", "table", "button", "caption", "html", "body", "foreignobject"})
#: End tags of others do not reach beyond these.
END_SCOPE = frozenset({"td", "th", "table", "caption", "foreignobject"})

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|"
    r"<([a-zA-Z][^\s/>]*)((?>[^>\"']|\"[^\"]*\"|'[^']*')*)>?",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
HIDING = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(visible|initial|hidden|collapse)", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self, name: str, default: str | None = None) -> str | None:
        if name in self.attributes.lower():
            for key, a, b, c in ATTRIBUTE.findall(self.attributes):
                if key.lower() == name:
                    return html.unescape(a or b or c)
        return default

    def hidden(self) -> bool:
        if self.tag in INVISIBLE:
            return True
        if not self.attributes:
            return self.tag == "dialog"
        if self.get("hidden") is not None or HIDING.search(self.get("style") or ""):
            return True
        return self.tag == "dialog" and self.get("open") is None


def parse(page: str) -> Node:
    """The tree of a page."""
    root = Node("html")
    stack, count = [root], {"html": 1}  # open elements, and how many of each

    def pop_to(depth: int) -> None:
        for node in stack[depth:]:
            count[node.tag] -= 1
        del stack[depth:]

    def close(tags, scope) -> None:
        if any(count.get(t) for t in tags):
            last = None
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in scope:
                    break
                if stack[depth].tag in tags:
                    last = depth
            if last:
                pop_to(last)

    def add_text(text: str) -> None:
        if stack[-1].tag == "head" and html.unescape(text).strip(" \t\n\r\f"):
            close(("head",), ())
        stack[-1].children.append(text)

    at, find = 0, page.find
    while at < len(page):
        opens = find("<", at)
        if opens < 0:
            opens = len(page)
        if opens > at:
            add_text(page[at:opens])
        if opens == len(page):
            break
        found = MARKUP.match(page, opens)
        if not found:
            add_text("<")
            at = opens + 1
            continue
        at = found.end()
        ends, starts = found[1], found[2]
        if ends:
            tag = ends.lower()
            if count.get(tag) and tag != "html":
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        pop_to(depth)
                        break
                    if stack[depth].tag in END_SCOPE and tag not in ("table", "tr", *CELLS, *SECTIONS):
                        break
            elif tag == "br":
                stack[-1].children.append(Node("br"))
            continue
        if not starts:
            continue
        tag = starts.lower()
        if tag == "html":
            continue
        if tag in CLOSES_P:
            close(("p",), P_SCOPE)
        if tag in CLOSES:
            close(*CLOSES[tag])
        if count.get("head") and tag not in ("meta", "link", "title", "base", "style", "script", "noscript", "template"):
            close(("head",), ())
        node = Node(tag, found[3])
        stack[-1].children.append(node)
        drawing = count.get("svg") and not count.get("foreignobject")
        if drawing and found[3].endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            stop = end.start() if end else len(page)
            node.children.append(page[at:stop])
            at = stop
            if end:
                at = (find(">", stop) + 1) or len(page)
        elif tag not in VOID and not found[3].endswith("/"):
            stack.append(node)
            count[tag] = count.get(tag, 0) + 1
        elif tag not in VOID and tag not in ("svg", "path", "use"):
            # HTML takes no notice of a slash on an element that is not void.
            stack.append(node)
            count[tag] = count.get(tag, 0) + 1
    return root


class Flow:
    """Lines of text with blocks, margins and list markers."""

    def __init__(self):
        self.lines: list[str] = []
        self.words: list[str] = []
        self.space, self.margin = False, 0
        self.indent, self.marker = "", ""

    def text(self, text: str, preformatted: bool) -> None:
        if preformatted:
            first, *more = text.replace("\r\n", "\n").split("\n")
            self.words.append(first)
            for line in more:
                self.flush(True)
                self.words.append(line)
            return
        plain = SPACE.sub(" ", text)
        if plain == " ":
            self.space = True
            return
        if (self.space or plain[0] == " ") and self.words:
            self.words.append(" ")
        self.words.append(plain.strip(" "))
        self.space = plain[-1] == " "

    def flush(self, keep_empty: bool = False) -> None:
        line = "".join(self.words)
        self.words, self.space = [], False
        if line or keep_empty:
            if self.lines:
                self.lines += [""] * self.margin
            self.lines.append(((self.marker or self.indent) + line).rstrip())
            self.margin, self.marker = 0, ""

    def block(self, margin: int) -> None:
        self.flush()
        self.margin = max(self.margin, margin)

    def whole(self) -> str:
        self.flush()
        return "\n".join(self.lines).strip("\n")


def wrapped(line: str) -> list[str]:
    """A line in parts of WIDEST characters at most, or of one longer word."""
    out, at = [], 0
    while len(line) - at > WIDEST:
        start = at
        while start < len(line) and line[start] == " ":
            start += 1
        cut = line.rfind(" ", start, at + WIDEST + 1)
        if cut < 0:
            cut = line.find(" ", max(start, at + WIDEST))
        if cut < 0:
            break
        out.append(line[at:cut].rstrip())
        at = cut
        while at < len(line) and line[at] == " ":
            at += 1
    return [*out, line[at:]]


class Table:
    def __init__(self):
        self.rows: list[list[tuple[str, int, int]]] = []
        self.captions: list[str] = []

    def lines(self) -> list[str]:
        """The cells in aligned columns."""
        grid: list[dict[int, str]] = []
        taken: dict[int, int] = {}  # column: rows that a span above still fills
        for row in self.rows:
            cells, column = {}, 0
            left = {c: n - 1 for c, n in taken.items() if n > 1}
            for text, across, down in row:
                while taken.get(column):
                    column += 1
                cells[column] = text
                if down > 1:
                    left.update({c: down - 1 for c in range(column, column + across)})
                column += across
            taken = left
            grid.append(cells)
        last = max((c for cells in grid for c, text in cells.items() if text), default=0)
        widths: dict[int, int] = {}
        split_rows = []
        for cells in grid:
            split: dict[int, list[str]] = {}
            below = 0  # lines down to the last one that runs into the columns to its right
            for column, text in sorted(cells.items()):
                lines = text.split("\n")
                if column < last:
                    lines = [part for line in lines for part in wrapped(line)]
                widths[column] = max(widths.get(column, 0), *(min(len(x), WIDEST) for x in lines))
                split[column] = [""] * below + lines if text else lines
                if column < last:
                    below = max([below, *(k + 1 for k, x in enumerate(split[column]) if len(x) > WIDEST)])
            split_rows.append(split)
        columns = sorted(c for c, w in widths.items() if w)
        out = []
        for split in split_rows:
            for k in range(max((len(s) for s in split.values()), default=0)):
                line = ""
                for c in columns:
                    part = split[c][k] if c in split and k < len(split[c]) else ""
                    line += part.ljust(widths[c] if c < last else 0) + "  "
                if line.strip():
                    out.append(line.rstrip())
        return out


def leave_out_unseen(root: Node) -> None:
    """Take away the text that `visibility` hides. Unlike `display` it is inherited and can be undone further in."""
    work = [(root, True)]
    while work:
        node, seen = work.pop()
        if node.attributes and (said := VISIBILITY.findall(node.get("style") or "")):
            seen = said[-1].lower() in ("visible", "initial")
        if not seen:
            node.children = [child for child in node.children if isinstance(child, Node)]
        work += [(child, seen) for child in node.children if isinstance(child, Node)]


def _number(value: str | None) -> int:
    return min(max(int(value), 1), MOST_SPAN) if value and value.isdigit() and len(value) < 9 else 1


def render(root: Node, drawings: bool = False) -> str:
    """The visible text of a tree; ``drawings``: also the text in svg."""
    flow = Flow()
    flows, tables, lists = [flow], [], []  # flows of cells, open tables, item counts of open lists
    pre = 0
    drawn: list[bool] = []  # open drawings and what shows text in them: whether text is left out
    # Elements to enter, and (None, element, indentation) where one ends.
    work: list = [root]
    while work:
        node = work.pop()
        if isinstance(node, str):
            flows[-1].text(html.unescape(node), pre > 0)
            continue
        if isinstance(node, Node):
            tag, flow = node.tag, flows[-1]
            if node.hidden() or tag == "svg" and not drawings:
                continue
            if drawn and (tag in SVG_UNSEEN or node.get("display") == "none" or node.get("visibility") in ("hidden", "collapse")):
                continue
            if tag == "svg" or drawn and tag in SVG_TEXT:
                drawn.append(tag == "svg")
                flow.space = True
            if tag == "br":
                flow.flush(True)
                continue
            kept = flow.indent
            if tag in BLOCKS:
                nested = tag in LISTS and lists
                flow.block(1 if tag in APART and not nested else 0)
            if tag in LISTS:
                start = node.get("start")
                lists.append((int(start) if start and re.fullmatch(r"-?\d{1,9}", start) else 1) if tag == "ol" else None)
            elif tag == "li":
                number = lists[-1] if lists else None
                mark = "- " if number is None else f"{number}. "
                if number is not None:
                    lists[-1] = number + 1
                flow.marker = flow.indent + mark
                flow.indent += " " * len(mark)
            elif tag in ("dd", "blockquote"):
                flow.indent += "  "
            elif tag in ("pre", "xmp"):
                pre += 1
                if node.children and isinstance(node.children[0], str):
                    node.children[0] = re.sub(r"\A\r?\n", "", node.children[0])
            elif tag == "table":
                tables.append((Table(), lists, pre))
                lists, pre = [], 0
            elif tag == "tr" and tables:
                tables[-1][0].rows.append([])
            elif tag in CELLS and tables or tag == "caption" and tables:
                flows.append(Flow())
            work.append((None, node, kept))
            children = node.children
            if tag == "details" and node.get("open") is None:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            if drawn and drawn[-1]:
                children = [c for c in children if isinstance(c, Node)]
            work.extend(reversed(children))
            continue
        _, node, kept = node
        tag = node.tag
        if tag == "svg" or drawn and tag in SVG_TEXT:
            drawn.pop()
            flows[-1].space = True
        if tag in CELLS and tables:
            text = flows.pop().whole()
            table = tables[-1][0]
            if not table.rows:
                table.rows.append([])
            table.rows[-1].append((text, _number(node.get("colspan")), _number(node.get("rowspan"))))
            continue
        if tag == "caption" and tables:
            tables[-1][0].captions.append(flows.pop().whole())
            continue
        flow = flows[-1]
        if tag in BLOCKS:
            nested = tag in LISTS and len(lists) > 1
            flow.block(1 if tag in APART and not nested else 0)
        if tag in LISTS:
            lists.pop()
        elif tag in ("pre", "xmp"):
            pre -= 1
        elif tag == "table":
            table, lists, pre = tables.pop()
            for line in [x for c in table.captions for x in c.split("\n") if x] + table.lines():
                flow.words.append(line)
                flow.flush()
            flow.margin = 1
        if tag in ("li", "dd", "blockquote"):
            flow.indent = kept
            flow.marker = ""
    return flows[0].whole()


def extract(page: str | None, drawings: bool = False) -> str | None:
    if page is None:
        return None
    tree = parse(page)
    if "visibility" in page.lower():
        leave_out_unseen(tree)
    return render(tree, drawings)


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, text."""

    @F.pandas_udf("string")
    def visible_text(htmls: pd.Series) -> pd.Series:
        return pd.Series([extract(h, drawings=True) if isinstance(h, str) else None for h in htmls], dtype=object)

    return pages.select(F.col(id_col).alias("page_id"), visible_text(F.col(html_col)).alias("text"))
