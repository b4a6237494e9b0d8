"""Visible text of HTML pages, laid out: blocks, lists and aligned tables.

A tree is built with the tags HTML implies (a paragraph ends where a block begins, an item where
the next begins, cells and rows likewise, the head where anything but its own elements comes); what
stands in a table outside its cells goes before the table; end tags without a start are ignored, and so
is what a comment, tag or attribute that never ends holds. Elements that are never shown, or are
hidden by attribute or inline style, are left out with all they hold.
The rest is rendered: white space collapses except in ``pre``; blocks begin on a line of their
own, and some are set off by an empty line; list items are indented and get a bullet or number;
table cells are padded to columns.

Formulas, text fields, the text of drawings and the options that a select displays are shown.
Left out are: stylesheets, scripts and images, which are not evaluated (so neither are pseudo
elements and alternative texts); what stands in for elements that browsers can show (noscript,
iframe, object, canvas, audio, video); values, placeholders and captions that are attributes of
input fields or groups of options; definitions in drawings that are only shown where another
element uses them. Nesting of any depth is handled without
recursion. Null and empty pages give an empty string.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "head script style template noscript noframes noembed iframe object applet canvas audio video datalist title "
    "annotation annotation-xml".split()
)
# Within a drawing: where text shows, and what is only a definition or a description.
SVG_SHOWN = frozenset(("text", "foreignobject"))
SVG_NEVER = frozenset("defs symbol clippath mask pattern marker lineargradient radialgradient filter desc metadata".split())
FOREIGN = frozenset(("svg", "math"))
SVG_TAGS = SVG_SHOWN | frozenset("svg g a switch tspan textpath".split())
# Inside these a drawing or formula holds HTML again; elsewhere in it, the start tags of the second set end it.
HTML_AGAIN = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
# What may stand in a head; any other start tag, and text, ends it and begins the body.
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes script style template head".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre listing xmp plaintext ul ol dl table figure hr menu dir".split())
BLOCK = APART | frozenset(
    "address article aside body caption center dd details dialog div dt fieldset figcaption footer form header hgroup "
    "html legend li main nav optgroup option search section summary tbody td tfoot th thead tr".split()
)
ENDS_P = BLOCK - frozenset("body html caption td th tr tbody thead tfoot option optgroup legend".split())
# With these all that they hold ends.
WHOLE = NEVER | FOREIGN | SVG_SHOWN | {"select", "textarea"}
CELLS = frozenset(("td", "th"))
GROUPS = frozenset(("thead", "tbody", "tfoot"))
LISTS = frozenset(("ul", "ol", "menu", "dir"))
# Whose content is text up to their own end tag, with and without character references.
REFERENCES = frozenset(("title", "textarea"))
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
# Where nothing but the parts of a table may stand, and what each part may stand in.
TABLE_ONLY = frozenset(("table", "tr")) | GROUPS
PART_OF = {
    **dict.fromkeys(("caption", "colgroup", *GROUPS), frozenset(("table",))),
    "col": frozenset(("table", "colgroup")),
    "tr": frozenset(("table",)) | GROUPS,
    **dict.fromkeys(CELLS, TABLE_ONLY),
}
# A new element of the key ends open ones of the first set, not looking beyond the second.
IMPLIED_END = {
    "li": (frozenset(("li",)), LISTS | {"table", "td", "th"}),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist", "optgroup"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select", "datalist"))),
    "td": (CELLS | {"caption"}, frozenset(("table", "tr"))),
    "th": (CELLS | {"caption"}, frozenset(("table", "tr"))),
    "tr": (frozenset(("tr", "caption", "colgroup")), frozenset(("table",))),
    "thead": (GROUPS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "tbody": (GROUPS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "tfoot": (GROUPS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "caption": (frozenset(("caption",)), frozenset(("table",))),
    "body": (frozenset(("head",)), frozenset()),
}
P_SCOPE = frozenset(("table", "td", "th", "caption", "button", "html"))
# The widest span a cell may ask for, as in the standard.
MOST_SPAN = 1000

_SPACE = re.compile(r"[ \t\n\f\r]+")
_HIDES = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.IGNORECASE)
_KEEPS_SPACE = re.compile(r"(?:^|;)\s*white-space\s*:\s*(pre|normal)", re.IGNORECASE)


_TAG = re.compile(r"</?([a-zA-Z][^ \t\n\f\r/>]*)")
_OPENS = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"[ \t\n\f\r/]*(>|=?[^ \t\n\f\r/>=]*)")
_EQUALS = re.compile(r"[ \t\n\f\r]*=[ \t\n\f\r]*")
_BARE = re.compile(r"[^ \t\n\f\r>]*")
_COMMENT_END = re.compile(r"--!?>")


class Node:
    __slots__ = ("tag", "attributes", "children", "home")

    def __init__(self, tag: str, attributes: dict[str, str | None], home: Node | None = None) -> None:
        self.tag, self.attributes, self.home = tag, attributes, home
        self.children: list[Node | str] = []


_ENDED = Node("", {})  # stands for an element that has ended while blocks in it are open


class TreeBuilder:
    """The tree of a page from its tags and texts; ``root`` holds everything."""

    def __init__(self) -> None:
        self.root = Node("#root", {})
        self.open = [self.root]
        # Where the open elements of each tag, and the open blocks, are: nothing is searched.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def start(self, tag: str, attributes: dict[str, str | None], slash: bool = False) -> None:
        if tag in ("html", "body") and any(node.tag == tag for node in self.open[:3]):
            return
        if tag not in IN_HEAD:
            self._leave_head(tag)
        if tag in ENDS_FOREIGN:
            self._close(FOREIGN, HTML_AGAIN)
        if tag in ("select", "input", "textarea") and self._has({"select"}, CELLS):
            self._close({"select"}, CELLS)
            if tag == "select":  # the start tag of a select in a select is its end
                return
        if tag in ENDS_P:
            self._close({"p"}, P_SCOPE)
        if tag in IMPLIED_END:
            ends, scope = IMPLIED_END[tag]
            self._close(ends, scope)
        if tag == "table" and self.open[-1].tag in TABLE_ONLY:  # a table that stands in no cell of another ends it
            self._close({"table"}, frozenset())
        if tag in PART_OF and self._has({"table"}, CELLS | {"caption"}):
            # What stands before the table by mistake ends where the table goes on.
            while self.open[-1].tag not in PART_OF[tag]:
                self._cut(len(self.open) - 1)
        if tag in CELLS and self.open[-1].tag in GROUPS | {"table"}:
            self._push("tr", {})
        if tag in VOID:
            self._put(Node(tag, attributes))
        else:
            self._push(tag, attributes)
        # A slash at the end means nothing in HTML, but ends an element of a drawing or formula.
        if slash and tag == self.open[-1].tag and self._has(FOREIGN, HTML_AGAIN - {tag}):
            self._close({tag}, frozenset())

    def end(self, tag: str) -> None:
        if tag == "br":
            self._leave_head(tag)
            self._put(Node("br", {}))
        elif tag == "p" and not self._has({"p"}, P_SCOPE):
            self._put(Node("p", {}))
        elif tag not in BLOCK and tag not in WHOLE and (at := self._has({tag}, CELLS)) and self.blocks and self.blocks[-1] > at:
            # The end of an inline element leaves the blocks in it open.
            self.open[at] = _ENDED
            self.places[tag].pop()
        elif tag not in VOID:
            # An end tag never closes the cell or table around it from within.
            self._close({tag}, frozenset() if tag in ("table", "html", "body") else frozenset(("table", "td", "th")) - {tag})

    def text(self, data: str) -> None:
        if not data:
            return
        blank = _SPACE.fullmatch(data)
        if self.open[-1].tag == "head" and not blank:
            self._leave_head("")
        if blank:
            self.open[-1].children.append(data)
        else:
            self._put(data)

    def in_foreign(self) -> bool:
        return bool(self._has(FOREIGN, HTML_AGAIN))

    def _leave_head(self, tag: str) -> None:
        """Ends a head that is innermost, and begins the body unless the tag does."""
        if self.open[-1].tag == "head":
            while self.open[-1].tag == "head":
                self._close({"head"}, frozenset())
            if tag != "body" and not self.places["body"]:
                self._push("body", {})

    def _put(self, child: Node | str) -> None:
        """A child of the innermost element, or one before the table where only parts of a table may stand."""
        top = self.open[-1]
        if top.tag not in TABLE_ONLY or isinstance(child, Node) and child.tag in PART_OF or not self.places["table"]:
            home, at = top, len(top.children)
        else:
            table = self.open[self.places["table"][-1]]
            home, at = table.home, len(table.home.children) - 1
            while home.children[at] is not table:
                at -= 1
        home.children.insert(at, child)
        if isinstance(child, Node):
            child.home = home

    def _push(self, tag: str, attributes: dict) -> None:
        node = Node(tag, attributes)
        self._put(node)
        self.places[tag].append(len(self.open))
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append(node)

    def _cut(self, at: int) -> None:
        """Ends the element at a place and all in it, and what had ended before around it."""
        while len(self.open) > at or self.open[-1] is _ENDED:
            node = self.open.pop()
            if node is not _ENDED:
                self.places[node.tag].pop()
                if node.tag in BLOCK:
                    self.blocks.pop()

    def _has(self, tags, scope) -> int:
        """Where the innermost open element of these tags is, 0 if there is none within the scope."""
        at = max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)
        return at if at >= max((self.places[tag][-1] for tag in scope if self.places.get(tag)), default=0) else 0

    def _close(self, tags, scope) -> None:
        # Every open element of these tags within the scope ends: a row with its cells.
        while at := self._has(tags, scope):
            self._cut(at)
            if len(tags) == 1:
                return


def _attributes(page: str, at: int) -> tuple[dict[str, str | None], int, bool] | None:
    """Attributes from a place behind a tag's name, the place behind its end, and whether a slash ends it; None without end."""
    found: dict[str, str | None] = {}
    while True:
        name = _NAME.match(page, at)
        if not name[1]:
            return None
        if name[1] == ">":
            return found, name.end(), page[name.end() - 2] == "/"
        at, value = name.end(), None
        equals = _EQUALS.match(page, at)
        if equals:
            at = equals.end()
            quote = page[at : at + 1]
            if quote in ("'", '"'):
                end = page.find(quote, at + 1)
                if end < 0:
                    return None
                value, at = page[at + 1 : end], end + 1
            else:
                bare = _BARE.match(page, at)
                value, at = bare[0], bare.end()
            value = unescape(value)
        found.setdefault(name[1].lower(), value)  # the first of repeated attributes counts


def parse(page: str) -> Node:
    """The tree of a page, in one pass from left to right; what never ends is ignored from where it begins."""
    page = page.replace("\r\n", "\n").replace("\r", "\n")
    builder = TreeBuilder()
    at, size = 0, len(page)
    while at < size:
        opens = _OPENS.search(page, at)
        begin = opens.start() if opens else size
        if page.startswith("</", begin) and begin + 2 == size:  # nothing is opened by these two at the end
            begin = size
        builder.text(unescape(page[at:begin]))
        at = begin
        if at >= size:
            break
        tag = _TAG.match(page, at)
        if tag:
            rest = _attributes(page, tag.end())
            if rest is None:
                break
            attributes, at, slash = rest
            name = tag[1].lower()
            if page[begin + 1] == "/":
                builder.end(name)
                continue
            foreign = builder.in_foreign()
            builder.start(name, attributes, slash)
            if name == "plaintext" and not foreign:
                builder.text(page[at:])
                break
            if name in ("script", "style") or name in RAW | REFERENCES and not foreign:
                close = re.compile(rf"</{name}(?=[ \t\n\f\r/>])", re.IGNORECASE).search(page, at)
                end = close.start() if close else size
                if not slash or not foreign:
                    builder.text(unescape(page[at:end]) if name in REFERENCES else page[at:end])
                    at = end
        elif page.startswith("<![CDATA[", at) and builder.in_foreign():
            end = page.find("]]>", at)
            builder.text(page[at + 9 : end if end >= 0 else size])
            at = end + 3 if end >= 0 else size
        elif page.startswith("<!--", at):
            if page.startswith(">", at + 4) or page.startswith("->", at + 4):
                at = page.index(">", at) + 1
                continue
            close = _COMMENT_END.search(page, at + 4)
            at = close.end() if close else size
        else:  # declarations, processing instructions and odd end tags
            end = page.find(">", at)
            at = end + 1 if end >= 0 else size
    return builder.root


class _Writer:
    """Lines of text with collapsed space, breaks and an indent."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.indent: list[str] = []
        self.mark = ""  # bullet or number of the item that has no text yet
        self.gap = False  # an empty line is due
        self.space = False  # a space is due

    def text(self, data: str, keep: bool) -> None:
        if keep:
            first, *rest = data.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._add(first)
            for part in rest:
                self.newline(True)
                self._add(part)
            return
        words = _SPACE.split(data)
        if len(words) == 1:
            self._add(data)
            return
        if not words[0]:
            self.space = True
        last = words[-1] == ""
        self._add(" ".join(word for word in words if word))
        if last:
            self.space = True

    def _add(self, data: str) -> None:
        if data:
            if self.space and self.line:
                self.line.append(" ")
            self.line.append(data)
            self.space = False

    def newline(self, always: bool = False) -> None:
        """Ends the line; an empty one is written only if asked."""
        if self.line or always:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append(("".join([*self.indent, self.mark]) + "".join(self.line)).rstrip(" "))
            if self.mark:
                self.indent.append(" " * len(self.mark))
                self.mark = ""
                self.marked = True
        self.line, self.space = [], False

    def block(self, apart: bool) -> None:
        self.newline()
        self.gap = self.gap or apart

    def block_lines(self, lines: list[str]) -> None:
        self.newline()
        for line in lines:
            self.line = [line]
            self.newline(True)


class _Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.captions: list[list[str]] = []


def render(root: Node) -> str:
    """The visible text of a tree, line by line, without recursion."""
    out = _Writer()
    writers, tables, counters = [out], [], []
    work: list[tuple] = [("node", root, True, False)]
    while work:
        step = work.pop()
        if step[0] == "node":
            _, node, visible, keep = step
            writer = writers[-1]
            if isinstance(node, str):
                if visible:
                    writer.text(node, keep)
                continue
            shown = _shown(node, visible)
            if shown is None:
                continue
            visible, tag = shown, node.tag
            keep = _keeps(node, keep)
            if tag == "br":
                writer.newline(True)
                continue
            if tag == "wbr" or tag == "img" or tag == "input":
                continue
            if tag == "table":
                writer.block(True)
                tables.append(_Table())
                work.append(("table",))
            elif tables and tag == "tr":
                tables[-1].rows.append([])
            elif tables and (tag in CELLS or tag == "caption"):
                if tag in CELLS and not tables[-1].rows:
                    tables[-1].rows.append([])
                writers.append(_Writer())
                work.append(("cell", node))
            elif tag in LISTS:
                writer.block(not counters)
                counters.append([tag == "ol", _number(node.attributes.get("start"), 1)])
                work.append(("list",))
            elif tag == "li":
                writer.block(False)
                writer.mark = _item_mark(node, counters)
                work.append(("item", len(writer.indent)))
            elif tag == "dd":
                writer.block(False)
                writer.indent.append("  ")
                work.append(("indent", len(writer.indent) - 1))
            elif tag == "blockquote":
                writer.block(True)
                writer.indent.append("  ")
                work.append(("quote", len(writer.indent) - 1))
            elif tag in BLOCK:
                apart = tag in APART
                writer.block(apart and not (tag == "p" and writer.mark))
                work.append(("block", apart))
            elif tag in SVG_SHOWN or tag == "math" and (node.attributes.get("display") or "").lower() == "block":
                writer.block(False)
                work.append(("block", False))
            elif tag == "tspan" and ("x" in node.attributes or "y" in node.attributes):
                writer.newline()
            elif tag == "svg":
                work.extend(("svg", child, visible) for child in reversed(node.children))
                continue
            children = node.children
            if tag == "select":
                children = _displayed(node)
            elif tag == "option" and node.attributes.get("label"):
                children = [node.attributes["label"]]
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            if tag in ("pre", "textarea") and children and isinstance(children[0], str):
                children = [re.sub(r"^\r?\n", "", children[0]), *children[1:]]
            work.extend(("node", child, visible, keep) for child in reversed(children))
        elif step[0] == "svg":
            _, node, visible = step
            shown = None if isinstance(node, str) or node.tag in SVG_NEVER else _shown(node, visible)
            if shown is not None:
                if node.tag in SVG_SHOWN:
                    work.append(("node", node, visible, False))
                else:
                    work.extend(("svg", child, shown) for child in reversed(node.children))
        elif step[0] == "block":
            writers[-1].block(step[1])
        elif step[0] == "list":
            counters.pop()
            writers[-1].block(not counters)
        elif step[0] in ("item", "indent", "quote"):
            writer = writers[-1]
            if step[0] == "item" and writer.mark:  # an item without text is still an item
                writer.newline(True)
            writer.block(step[0] == "quote")
            del writer.indent[step[1] :]
        elif step[0] == "cell":
            writer = writers.pop()
            writer.newline()
            while writer.lines and not writer.lines[-1]:
                writer.lines.pop()
            node = step[1]
            if node.tag == "caption":
                tables[-1].captions.append(writer.lines)
            else:
                across, down = (_span(node, name) for name in ("colspan", "rowspan"))
                tables[-1].rows[-1].append((writer.lines, across, down))
        else:
            lines = _table_lines(tables.pop())
            writers[-1].block_lines(lines)
            writers[-1].block(True)
    out.newline()
    while out.lines and not out.lines[-1]:
        out.lines.pop()
    return "\n".join(out.lines).lstrip("\n")


def _shown(node: Node, visible: bool) -> bool | None:
    """Whether text directly in the element shows; None if nothing in it can."""
    if node.tag in NEVER:
        return None
    attributes = node.attributes
    if not attributes:
        return None if node.tag == "dialog" else visible
    if "hidden" in attributes or "popover" in attributes or node.tag == "dialog" and "open" not in attributes:
        return None
    style = attributes.get("style")
    if style:
        if _HIDES.search(style):
            return None
        found = _VISIBILITY.search(style)
        if found:
            return found[1].lower() == "visible"
    if node.tag in SVG_TAGS:
        if (attributes.get("display") or "").strip().lower() == "none":
            return None
        said = (attributes.get("visibility") or "").strip().lower()
        if said in ("hidden", "collapse", "visible"):
            return said == "visible"
    return visible


def _displayed(select: Node) -> list[Node | str]:
    """What a select shows: all options of a list, else the chosen option's text, or the first that may be chosen."""
    options, work = [], [(child, False) for child in reversed(select.children)]
    while work:
        node, off = work.pop()
        if isinstance(node, Node):
            off = off or "disabled" in node.attributes
            if node.tag == "option":
                options.append((node, off))
            else:
                work.extend((child, off) for child in reversed(node.children))
    if "multiple" in select.attributes or _number(select.attributes.get("size"), 1) > 1:
        return select.children
    chosen = [node for node, _ in options if "selected" in node.attributes][-1:]
    for node in chosen or [node for node, off in options if not off][:1]:
        label = node.attributes.get("label")
        return [label] if label else node.children
    return []


def _keeps(node: Node, keep: bool) -> bool:
    if node.tag in ("pre", "listing", "xmp", "plaintext", "textarea"):
        return True
    style = node.attributes.get("style") if node.attributes else None
    found = _KEEPS_SPACE.search(style) if style else None
    return found[1].lower() == "pre" if found else keep


def _number(value: str | None, otherwise: int) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return int(found[1]) if found else otherwise


def _span(node: Node, name: str) -> int:
    return min(max(_number(node.attributes.get(name), 1), 1), MOST_SPAN)


def _item_mark(node: Node, counters: list) -> str:
    if not counters or not counters[-1][0]:
        return "- "
    number = _number(node.attributes.get("value"), counters[-1][1])
    counters[-1][1] = number + 1
    return f"{number}. "


def _width(text: str) -> int:
    """Columns a line takes on a screen: wide characters two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _table_lines(table: _Table) -> list[str]:
    """Rows as lines; every column is as wide as its widest cell that spans no other."""
    widths: dict[int, int] = {}
    placed, taken = [], {}
    for cells in table.rows:
        row, at = [], 0
        for lines, across, down in cells:
            while taken.get(at, 0):
                at += 1
            row.append((at, across, lines))
            for column in range(at, at + across):
                taken[column] = max(taken.get(column, 0), down)
            if across == 1:
                widths[at] = max([widths.get(at, 0), *map(_width, lines)])
            at += across
        taken = {column: rows - 1 for column, rows in taken.items() if rows > 1}
        placed.append(row)
    last = max([at + across for row in placed for at, across, _ in row], default=0)
    begin, sum_ = [], 0
    for column in range(last):
        begin.append(sum_)
        sum_ += widths[column] + 2 if column in widths else 0
    out = [line for lines in table.captions for line in lines]
    for row in placed:
        for number in range(max([len(lines) for _, _, lines in row], default=0)):
            line, filled = [], 0
            for at, _, lines in row:
                text = lines[number] if number < len(lines) else ""
                if not text:
                    continue
                pad = max(begin[at] - filled, 2 if filled else 0)
                line += [" " * pad, text]
                filled += pad + _width(text)
            out.append("".join(line))
    return out


def page_text(page: str | None) -> str:
    return render(parse(page)) if page else ""


def visible_text(html: Column) -> Column:
    """The laid-out text of every page."""

    @F.arrow_udf("string")
    def rendered(pages: pa.Array) -> pa.Array:
        return pa.array([page_text(page.as_py()) for page in pages], pa.string())

    return rendered(html.cast("string"))
