"""HTML extraction by layout-aware rendering: all visible text, with block spacing, lists and aligned tables.

A tree builder closes implied tags (a paragraph before a block, a list item before the next, table parts),
visibility rules drop what a browser does not show, and a renderer lays out what is left: blocks on lines of
their own with a blank line around paragraphs and headings, bullets or numbers before list items, indented
nested lists, preformatted text as it is, and table cells padded to the width of their column.

Hidden are what browsers hide: scripts and the like, ``hidden``, ``display:none``, closed dialogs, closed details but for
their summary, and ``visibility:hidden`` but for descendants made visible again.  Formulas and the labels of drawings are shown,
without their titles, descriptions, definitions and annotations.  Cells over ``WIDEST_CELL`` characters don't
widen their column, so that one long cell doesn't pad all other rows.

Defined results: NULL html gives NULL text; empty html gives the empty text.  Broken markup never fails and takes time
in proportion to its length: stray end tags are ignored, a tag, comment or quoted value that never ends takes the rest of
the page, open elements end with the page.  Repeated rows are rendered each; extra columns are kept, but one named
``text`` gives way to the result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import table

# Fixed sets of the HTML standard.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("head script style template noscript title iframe object audio video canvas datalist noembed noframes".split())
#: Parts of a drawing or formula that aren't drawn.  They are hidden there only, elsewhere such names are unknown elements.
UNDRAWN = {"svg": set("desc metadata defs symbol clippath mask pattern marker".split()), "svg text": {"desc", "metadata"},
           "math": {"annotation", "annotation-xml"}}
#: Elements of drawings and formulas that hold HTML again.
HTML_INSIDE = {"svg": {"foreignobject", "desc"}, "svg text": {"desc"}, "math": set("annotation-xml mi mo mn ms mtext".split())}
#: HTML elements that end an open drawing or formula.
ENDS_DRAWING = set("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre
 ruby s small span strong strike sub sup table tt u ul var""".split())
#: The head holds these; all others end it.
HEAD_PARTS = set("base basefont bgsound link meta title noscript noframes style script template".split())
BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3
 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption option optgroup textarea""".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl pre table figure".split())
#: A start tag closes these open elements, unless one of the barriers stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
PARAGRAPH_ENDS = BLOCK - {"html", "body", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "li", "dt", "dd"} | {"hr"}
#: Elements whose content is text up to their own end tag; those of the second set may hold character references.
RAW, ESCAPED_RAW = set("script style xmp iframe noembed noframes".split()), {"title", "textarea"}
PREFORMATTED = {"pre", "textarea", "xmp", "listing"}
SCOPES = {"table", "td", "th", "caption", "button", "html"}
ROW_GROUPS = {"tbody", "thead", "tfoot"}
#: A part of a table ends whatever is open inside its table (a caption, a column group, a cell), up to one of these.
TABLE_PARTS = {**dict.fromkeys((*ROW_GROUPS, "caption", "colgroup", "col"), {"table"}), "tr": {"table"} | ROW_GROUPS,
               **dict.fromkeys(("td", "th"), {"table", "tr"} | ROW_GROUPS)}
WIDEST_CELL = 120
#: The standard's limits of spans.
WIDEST_SPAN, HIGHEST_SPAN = 1000, 65534

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_ATTRIBUTE = re.compile(r"[\s/]*+(=?[^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([\"'])|([^\s>]*+)))?+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
_DECLARATION = re.compile(r"([^:;]*+):((?:[^;\"'(]|\"[^\"]*+\"?|'[^']*+'?|\([^)]*+\)?)*+)")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW | ESCAPED_RAW}


class Node:
    __slots__ = ("tag", "attrs", "children", "shown", "pre", "language", "inside", "display")

    def __init__(self, tag: str, attrs: dict, parent: Node | None = None):
        self.tag, self.attrs, self.children = tag, attrs, []
        # "" for HTML, "svg", "svg text" or "math": of the element, and of what it holds.
        self.language = parent.inside if parent is not None else ""
        self.inside = "" if tag in HTML_INSIDE.get(self.language, ()) else self.language
        if tag in ("svg", "math"):
            self.inside = tag
        elif tag == "text" and self.language == "svg":
            self.inside = "svg text"
        style = self.style()
        self.pre = tag in PREFORMATTED or style.get("white-space", "").startswith("pre") or parent is not None and parent.pre
        self.display = style.get("display")
        visibility = style.get("visibility")
        self.shown = (visibility == "visible" or parent is None or parent.shown) and visibility not in ("hidden", "collapse")

    def style(self) -> dict[str, str]:
        """Declarations of the element's own style; the last of a property holds, but for an important one."""
        found: dict[str, str] = {}
        if self.tag == "svg" or self.language[:3] == "svg":  # here these are attributes as well
            found = {k: self.attrs[k].strip().lower() for k in ("display", "visibility") if self.attrs.get(k)}
        important = set()
        for name, value in _DECLARATION.findall(_COMMENT.sub(" ", self.attrs.get("style") or "")):
            name, value = name.strip().lower(), value.strip().lower()
            marked = value.endswith("important") and value[:-9].rstrip().endswith("!")
            if marked:
                important.add(name)
                value = value[:-9].rstrip()[:-1].rstrip()
            if marked or name not in important:
                found[name] = value
        return found

    def visible(self) -> bool:
        return not (self.tag in HIDDEN or self.tag in UNDRAWN.get(self.language, ()) or self.display == "none"
                    or "hidden" in self.attrs and self.display is None or self.tag == "dialog" and "open" not in self.attrs)

    def apart(self, parent: Node) -> bool:
        """Whether a part of a drawing or formula stands apart from its neighbours."""
        if self.language == "math":
            return self.tag in ("mtr", "mtd") or parent.tag == "mfrac"
        return self.inside == "svg text" and (self.tag == "text" or not self.attrs.keys().isdisjoint(("x", "y", "dy")))


class TreeBuilder:
    """Elements and texts of a page in one pass over it."""

    def __init__(self, page: str):
        self.root = Node("html", {})
        self.stack = [self.root]
        #: Places in the stack of the open elements, by tag.
        self.places: dict[str, list[int]] = defaultdict(list, html=[0])
        self.begun = False  # whether anything but space has been read
        at = 0
        while at < len(page):
            at = self.step(page, at)

    def step(self, page: str, at: int) -> int:
        """Takes one text, comment or tag from ``at`` on and tells where the next begins."""
        if page[at] != "<":
            end = page.find("<", at)
            end = end if end >= 0 else len(page)
            self.text(unescape(page[at:end]))
            return end
        if page.startswith("<![CDATA[", at) and (self.stack[-1].language or self.stack[-1].inside):
            end = page.find("]]>", at)
            self.text(page[at + 9:end if end >= 0 else len(page)])
            return end + 3 if end >= 0 else len(page)
        following = page[at + 1:at + 2]
        if page.startswith("<!--", at):
            ends = [page.find(mark, at + 2) for mark in ("-->", "--!>")]
            ends = [e + 3 + k for k, e in enumerate(ends) if e >= 0]
            return min(ends, default=len(page))
        if following == "/" and (name := _NAME.match(page, at + 2)):
            end = page.find(">", name.end())
            self.end(name[0].lower())
            return end + 1 if end >= 0 else len(page)
        if following and following in "!?/":  # declarations and what browsers take for a comment
            end = page.find(">", at)
            return end + 1 if end >= 0 else len(page)
        if name := _NAME.match(page, at + 1):
            return self.start_tag(page, name[0].lower(), name.end())
        self.text("<")
        return at + 1

    def start_tag(self, page: str, tag: str, at: int) -> int:
        attrs: dict[str, str | None] = {}
        while True:
            found = _ATTRIBUTE.match(page, at)
            at = found.end()
            if found[1]:
                if found[4]:
                    return len(page)  # a quoted value that never ends
                value = next((found[k] for k in (2, 3, 5) if found[k] is not None), None)
                attrs.setdefault(found[1].lower(), None if value is None else unescape(value))
            if at >= len(page):
                return at
            if page[at] == ">":
                break
        # In drawings and formulas a slash before the end closes the element, unless it belongs to an unquoted value.
        closed = not found[1] and page[at - 1] == "/"
        at += 1
        node = self.start(tag, attrs, closed)
        if closed and node.language:
            return at
        if tag == "plaintext":
            node.children.append(page[at:])
            return len(page)
        if tag not in _RAW_END:
            return at
        end = _RAW_END[tag].search(page, at)
        raw = page[at:end.start() if end else len(page)]
        node.children.append(unescape(raw) if tag in ESCAPED_RAW else raw)
        if not end:
            return len(page)
        close = page.find(">", end.end())
        return close + 1 if close >= 0 else len(page)

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.stack))
        self.stack.append(node)

    def cut(self, at: int) -> None:
        """Ends the open elements from this place on."""
        while len(self.stack) > max(at, 1):
            self.places[self.stack.pop().tag].pop()

    def nearest(self, tags) -> int:
        """Place of the innermost open element of these tags, 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places[t]), default=0)

    def close_open(self, tags: set[str], barriers: set[str]) -> None:
        """Ends the open elements of these tags, outermost included, up to a barrier."""
        barrier = self.nearest(barriers)
        found = [places[k] for t in tags if (k := bisect_right(places := self.places[t], barrier)) < len(places)]
        if found:
            self.cut(min(found))

    def to_table(self, barriers: set[str]) -> None:
        """Ends the open elements above the nearest of the barriers, if there is one."""
        at = self.nearest(barriers)
        if at > self.nearest(("template", "noscript")):
            self.cut(at + 1)

    def start(self, tag: str, attrs: dict, closed: bool = False) -> Node:
        if tag == "html" or tag == "head" and self.begun:
            return self.root
        self.begun = True
        while tag in ENDS_DRAWING and self.stack[-1].inside:
            self.cut(len(self.stack) - 1)
        if tag in PARAGRAPH_ENDS:
            self.close_open({"p"}, SCOPES)
        if tag in CLOSES:
            self.close_open(*CLOSES[tag])
        if self.stack[-1].tag == "colgroup" and tag not in ("col", "template"):
            self.cut(len(self.stack) - 1)
        elif tag in TABLE_PARTS and not (tag == "col" and self.stack[-1].tag == "colgroup"):
            self.to_table(TABLE_PARTS[tag])
        if self.stack[-1].tag == "head" and tag not in HEAD_PARTS:
            self.cut(len(self.stack) - 1)  # content begins: the head ends by itself
        if tag in ("td", "th") and self.stack[-1].tag in {"table"} | ROW_GROUPS:
            self.start("tr", {})
        # A form between the parts of a table holds nothing, its rows and cells stay those of the table.
        empty = tag == "form" and self.stack[-1].tag in {"table", "tr"} | ROW_GROUPS
        node = Node(tag, attrs, self.stack[-1])
        self.stack[-1].children.append(node)
        empty |= closed and (node.language or node.inside) != ""
        if tag not in VOID and tag not in _RAW_END and not empty:
            self.push(node)
        return node

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        elif tag not in ("html", "body"):
            scopes = () if tag in ("table", "tr", "tbody", "thead", "tfoot", "template", "noscript") else SCOPES
            at = self.nearest((tag,))
            if at and at >= self.nearest(scopes):
                self.cut(at)
            elif tag == "p":  # one that closes nothing is an empty paragraph
                self.start("p", {})
                self.end("p")

    def text(self, data: str) -> None:
        if data.strip():
            self.begun = True
            if self.stack[-1].tag in ("colgroup", "head"):
                self.cut(len(self.stack) - 1)
        self.stack[-1].children.append(data)


class Lines:
    """Collects text: inline runs, line ends, and blank lines of which neighbours are joined."""

    def __init__(self):
        self.lines: list[str] = []
        self.pieces: list[str] = []
        self.blank = False

    def inline(self, text: str) -> None:
        for k, part in enumerate(text.split("\xa0")):  # a no-break space is never joined with others
            words = " ".join(part.split())
            lead = " " if part[:1].isspace() else ""
            tail = " " if part[-1:].isspace() and words else ""
            piece = ("\xa0" if k else "") + lead + words + tail
            if not self.pieces or self.pieces[-1].endswith(" "):
                piece = piece.lstrip(" ")
            self.put(piece)

    def put(self, piece: str) -> None:
        if piece:
            self.pieces.append(piece)

    def end_line(self, keep_empty: bool = False) -> None:
        line = "".join(self.pieces).rstrip(" ")
        self.pieces = []
        if line or keep_empty:
            if self.blank and self.lines and self.lines[-1]:
                self.lines.append("")
            self.blank = False
            self.lines.append(line)

    def space(self) -> None:
        self.end_line()
        self.blank = True

    def add(self, block: list[str]) -> None:
        self.end_line()
        for line in block:
            if line:
                self.pieces = [line]
                self.end_line()
            else:
                self.blank = True


def rows_of(node: Node):
    """Visible rows of a table, each with its row group."""
    todo = [(node, iter(node.children))]
    while todo:
        group, children = todo[-1]
        child = next(children, None)
        if child is None:
            todo.pop()
        elif isinstance(child, Node) and child.visible():
            if child.tag == "tr":
                yield group, child
            elif child.tag in ROW_GROUPS:
                todo.append((child, iter(child.children)))


def loose_parts(node: Node):
    """What stands in a table beside its rows: for the table and each of its row groups, a node of these children."""
    todo = [node]
    while todo:
        node = todo.pop()
        loose, groups = Node("div", {}, node), []
        loose.shown = node.shown
        for child in node.children:
            if isinstance(child, Node) and child.tag in ROW_GROUPS:
                groups += [child] if child.visible() else []
            elif isinstance(child, str) or child.tag not in ("tr", "colgroup", "col"):
                loose.children.append(child)
        yield loose
        todo += reversed(groups)


def span(cell: Node, name: str, most: int) -> int:
    value = whole(cell.attrs.get(name))
    return 1 if value is None else most if name == "rowspan" and value == 0 else min(max(value, 1), most)


def table_lines(node: Node):
    """Rows with cells aligned by column; a cell of several lines takes several lines, one over several rows keeps its columns
    in all of them.  Every visible part of the table is kept.  Columns without any text take no room."""
    out = Lines()
    for loose in loose_parts(node):
        out.add((yield block_lines(loose)))
    rows: list[dict[int, list[str]]] = []
    taken: list[tuple[int, int, int]] = []  # first and past-the-end column of cells of rows above, and the last row they reach
    before = None
    for k, (group, row) in enumerate(rows_of(node)):
        taken = sorted(t for t in taken if t[2] >= k) if group is before else []
        before, cells, column, passed = group, {}, 0, 0
        for cell in row.children:
            if isinstance(cell, str) and not (cell.strip() and row.shown) or isinstance(cell, Node) and (
                    not cell.visible() or cell.tag == "form" and not cell.children):
                continue
            while passed < len(taken) and taken[passed][0] <= column:
                column, passed = max(column, taken[passed][1]), passed + 1
            cells[column] = (yield block_lines(cell)) if isinstance(cell, Node) else [" ".join(cell.split())]
            wide, high = (span(cell, "colspan", WIDEST_SPAN), span(cell, "rowspan", HIGHEST_SPAN)) if isinstance(cell, Node) else (1, 1)
            if high > 1:
                taken.append((column, column + wide, k + high - 1))
            column += wide
        rows.append(cells)
    widths: dict[int, int] = {}
    for cells in rows:
        for column, lines in cells.items():
            if lines:
                widths[column] = max([widths.get(column, 0), *(len(x) for x in lines if len(x) <= WIDEST_CELL)])
    columns = sorted(widths)
    place = {column: at for at, column in enumerate(columns)}
    for cells in rows:
        filled = max((place[c] + 1 for c, lines in cells.items() if lines), default=0)
        for k in range(max(map(len, cells.values()), default=0)):
            line = "  ".join((cells[c][k] if c in cells and k < len(cells[c]) else "").ljust(widths[c]) for c in columns[:filled]).rstrip(" ")
            out.add([line])
    return out.lines


def run(steps):
    """Runs a generator that yields generators whose results it needs: calls without depth."""
    stack, value = [steps], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


def block_lines(node: Node):
    out = Lines()
    yield render(node, out)
    out.end_line()
    return out.lines


def indented(lines: list[str], first: str) -> list[str]:
    return [(first if not k else " " * len(first)) + x if x else "" for k, x in enumerate(lines)]


def whole(value: str | None) -> int | None:
    return int(value) if value and value.isascii() and value.isdigit() and len(value) < 10 else None


def numeral(number: int, kind: str | None) -> str:
    """A list number in the style of the list's type."""
    if kind in ("a", "A") and number > 0:
        letters = ""
        while number > 0:
            number, k = divmod(number - 1, 26)
            letters = chr(ord(kind) + k) + letters
        return letters
    if kind in ("i", "I") and 0 < number < 4000:
        roman = ""
        for value, sign in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"),
                            (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
            roman += sign * (number // value)
            number %= value
        return roman if kind == "i" else roman.upper()
    return str(number)


def render(node: Node, out: Lines):
    number = whole(node.attrs.get("start")) if node.tag == "ol" else None
    down = node.tag == "ol" and "reversed" in node.attrs
    if number is None:
        number = sum(isinstance(c, Node) and c.tag == "li" and c.visible() for c in node.children) if down else 1
    closed = node.tag == "details" and "open" not in node.attrs
    for child in node.children:
        if closed and not (isinstance(child, Node) and child.tag == "summary"):
            continue
        if isinstance(child, str):
            if not node.shown or node.inside == "svg":
                continue
            if node.pre:
                if node.tag in PREFORMATTED and child is node.children[0]:
                    child = child.removeprefix("\r").removeprefix("\n")
                parts = child.expandtabs(4).replace("\r\n", "\n").split("\n")
                for k, part in enumerate(parts):
                    out.put(part)
                    if k < len(parts) - 1:
                        out.end_line(keep_empty=True)
            else:
                out.inline(child)
            continue
        if not child.visible():
            continue
        if child.tag == "br":
            if out.pieces:
                out.end_line(keep_empty=True)
            else:
                out.blank = True
        elif child.tag == "hr":
            out.space()
        elif child.tag == "img":
            if child.attrs.get("alt") and child.shown:
                out.inline(" " + child.attrs["alt"] + " ")
        elif child.tag == "table":
            out.space()
            out.add((yield table_lines(child)))
            out.space()
        elif child.tag == "li":
            value = whole(child.attrs.get("value"))
            number = number if value is None else value
            mark = "- " if node.tag != "ol" else f"{numeral(number, child.attrs.get('type') or node.attrs.get('type'))}. "
            number += -1 if down else 1
            out.add(indented((yield block_lines(child)), mark))
        elif child.tag in ("dd", "blockquote"):
            out.add(indented((yield block_lines(child)), "    " if child.tag == "dd" else "  "))
        elif child.tag in BLOCK:
            out.end_line()
            if child.tag in SPACED and node.tag != "li":
                out.space()
            yield render(child, out)
            out.end_line()
            if child.tag in SPACED and node.tag != "li":
                out.space()
        else:
            apart = " " if child.apart(node) else ""
            out.inline(apart)
            yield render(child, out)
            out.inline(apart)


def rendered(html: str | None) -> str | None:
    if html is None:
        return None
    return "\n".join(run(block_lines(TreeBuilder(html).root)))


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` in place of ``html``."""
    others = [c for c in pages.columns if c not in ("html", "text")]

    def render_batches(batches):
        for batch in batches:
            text = pa.array([rendered(h) for h in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), text], names=[*others, "text"])

    kinds = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in others)
    return pages.select(*others, F.col("html")).mapInArrow(render_batches, kinds + "text string")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
