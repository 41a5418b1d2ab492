"""Visible text of web pages: a tree with implied tags, visibility rules, and a layout of blocks.

Tags are read by the standard library's tokenizer. The tree builder supplies end tags that HTML
leaves out (a paragraph ends at the next block, a list item at the next item, a cell at the next
cell or row) and ignores end tags that close nothing. The renderer then writes

- each block on lines of its own, paragraphs, headings, lists and tables with an empty line around;
- list items behind "- " or their number, nested lists indented;
- tables with their cells padded to the width of their column, places that a cell of a row above covers left free;
- `pre` and `textarea` with their white space, other text with runs of white space as one blank;
- of a menu (`select`) the chosen option, of a list box all options, on lines of their own;
- formulas (`math`) without annotations, parts of fractions and tables apart by a blank;
- labels of drawings (`svg`), apart by a blank.

No text that a browser shows is left out: navigation, advertisements and footers are text like any
other. Not shown: head, scripts, styles, templates, comments, titles, choices that are not picked,
what stands in for media that a browser plays or embeds (object, video, audio, canvas, iframe), definitions
in drawings, elements hidden by attribute or inline style (the last declaration counts, visibility is inherited), and
the bodies of closed details. Values of attributes (of `input`, `img`)
are not text, apart from the label of an option; style sheets and references inside drawings are not followed.
"""

import sys
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser
from unicodedata import combining, east_asian_width

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values of HTML: elements without content, and groups of elements by their default layout
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("head script style template noscript title datalist object video audio canvas iframe".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure article section".split())
BLOCK = SPACED | frozenset(
    "address aside body caption center dd details dialog dir div dt fieldset figcaption footer form header hgroup hr "
    "html legend li main menu nav search summary tbody td tfoot th thead tr".split()
)
LISTS = frozenset(("ul", "ol", "menu", "dir"))
# element -> (open elements that its start ends, elements beyond which it does not look)
_TABLE = ("table",)
ENDS = {
    "li": (("li",), tuple(LISTS)),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", *_TABLE)),
    "th": (("td", "th"), ("tr", *_TABLE)),
    "tr": (("tr",), _TABLE),
    "tbody": (("thead", "tbody", "tfoot", "caption", "colgroup"), _TABLE),
    "thead": (("thead", "tbody", "tfoot", "caption", "colgroup"), _TABLE),
    "tfoot": (("thead", "tbody", "tfoot", "caption", "colgroup"), _TABLE),
    "body": (("head",), ()),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("optgroup",), ("select", "datalist")),
}
# all that an open head holds; any other element, or text that is not blank, ends it
IN_HEAD = frozenset("base link meta title style script noscript noframes template".split())
ENDS_PARAGRAPH = BLOCK - frozenset("html body tbody td tfoot th thead tr caption".split())
# elements of HTML that end an open formula or drawing, unless they stand in a part of it that holds HTML
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
TOKENS = frozenset("mi mo mn ms mtext".split())
HOLDS_HTML = TOKENS | frozenset("foreignobject desc title annotation-xml".split())
FOREIGN = frozenset(("svg", "math"))
# elements whose shown text is not that of their children one after the other
OWN_TEXT = FOREIGN | frozenset(("select", "textarea"))
# parts of drawings and formulas that are not drawn, and parts of formulas that stand side by side or above each other
UNDRAWN = frozenset("defs desc metadata symbol clippath mask marker pattern lineargradient radialgradient filter".split())
UNDRAWN_MATH = frozenset("annotation annotation-xml mphantom".split())
APART = frozenset("mfrac mroot mtable mtr mlabeledtr munder mover munderover".split())
# an end tag is not looked for outside the cell or table it stands in
SCOPE = frozenset("table td th caption".split())
SPACE = regex.compile(r"[ \t\n\r\f]+")
# elements that make no difference inside each other: texts in a line, and plain blocks without a neighbour
INLINE = frozenset(
    "a abbr b bdi bdo big cite code del em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var".split()
)
PLAIN = frozenset("address aside center div fieldset footer form header hgroup main nav search".split())
# below so many levels that do make a difference (browsers stop there too), blocks are lines of their parent
DEPTH = 512
# a level of the tree takes a few calls to render
CALLS = 20 * DEPTH


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str | None]):
        self.tag, self.attributes, self.children = tag, attributes, []


class TreeBuilder(HTMLParser):
    """Elements as nodes, texts as strings, below one root."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = [Node("root", {})]
        self.tags = Counter()  # open elements by tag, so that most searches among them end at once
        self.drawn = False  # whether the page has a formula or drawing

    def _close(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.tags[node.tag] -= 1
        del self.open[depth:]

    def _end_head(self) -> None:
        if self.open[-1].tag == "head":
            self._close(len(self.open) - 1)

    def _end_implied(self, tag: str) -> None:
        if tag not in IN_HEAD and tag != "head":
            self._end_head()
        ended, limit = ENDS.get(tag, ((), ()))
        if tag in ENDS_PARAGRAPH:
            self._close_within(("p",), tuple(SCOPE))
        if tag == "optgroup":
            self._close_within(("option",), ("optgroup", *limit))
        if ended:
            self._close_within(ended, limit)

    def _close_within(self, tags, limit) -> None:
        if not any(self.tags[t] for t in tags):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in tags:
                self._close(depth)
                return
            if self.open[depth].tag in limit:
                return

    def _foreign(self) -> int:
        """Where the outermost formula or drawing is open that what follows belongs to; 0 if in none."""
        found = 0
        if not any(self.tags[t] for t in FOREIGN):
            return found
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in HOLDS_HTML:
                break
            if self.open[depth].tag in FOREIGN:
                found = depth
        return found

    def _start(self, tag, attrs) -> Node:
        of_html = tag in ENDS_FOREIGN or (tag == "font" and {"color", "face", "size"} & {k for k, _ in attrs})
        if self.drawn and of_html and (depth := self._foreign()):
            self._close(depth)
        self._end_implied(tag)
        node = Node(tag, {})
        for name, value in attrs:  # of a repeated attribute the first counts
            node.attributes.setdefault(name, value)
        self.open[-1].children.append(node)
        self.drawn = self.drawn or tag in FOREIGN
        if tag == "textarea" and not (self.drawn and self._foreign()):
            self.set_cdata_mode(tag)  # tags in it are text
        return node

    def _push(self, node: Node) -> None:
        if node.tag not in VOID:
            self.open.append(node)
            self.tags[node.tag] += 1

    def handle_starttag(self, tag, attrs):
        self._push(self._start(tag, attrs))

    def handle_startendtag(self, tag, attrs):
        node = self._start(tag, attrs)
        # only formulas, drawings and their parts end at once
        if not (tag in FOREIGN or self.drawn and self._foreign()):
            self._push(node)

    def handle_endtag(self, tag):
        if tag == "p" and not self.tags["p"]:
            self.handle_starttag("p", [])  # a lone </p> is an empty paragraph
        self._close_within((tag,), tuple(SCOPE - {tag}) if tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html") else ())

    def handle_data(self, data):
        if data.strip(" \t\n\r\f"):
            self._end_head()
        self.open[-1].children.append(unescape(data) if self.cdata_elem == "textarea" else data)


def tree(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    if builder.cdata_elem == "textarea":  # left open: the tokenizer would drop what it holds
        rest, builder.rawdata = builder.rawdata, ""
        builder.handle_data(rest)
    builder.close()
    return builder.open[0]


def declared(style: str | None) -> dict[str, str]:
    """Values of the inline style's properties: the last one counts, or the last that is marked important."""
    out: dict[str, tuple[bool, str]] = {}
    for part in (style or "").split(";"):
        name, _, value = part.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        important = value.endswith("important") and "!" in value
        if value and (important or not out.get(name, (False, ""))[0]):
            out[name] = important, value.split("!")[0].strip()
    return {name: value for name, (_, value) in out.items()}


def visible(node: Node) -> bool:
    """Whether an element has a place on the page at all."""
    a = node.attributes
    if node.tag in UNSEEN:
        return False
    display = declared(a["style"]).get("display") if a.get("style") else None
    if display:  # it also overrules what hides the element by default
        return display != "none"
    return "hidden" not in a and not (node.tag == "dialog" and "open" not in a)


def _hide(root: Node) -> list[tuple[Node, int]]:
    """Drop hidden texts and the bodies of closed details; returns all elements with their depth, parents first.

    Visibility is inherited: below a hidden element only those elements show texts that are declared visible.
    """
    found, stack = [], [(root, 0, False)]
    while stack:
        node, depth, hidden = stack.pop()
        found.append((node, depth))
        if hidden:
            node.children = [c for c in node.children if isinstance(c, Node)]
            node.attributes.pop("label", None)
        if node.tag == "details" and "open" not in node.attributes:
            node.children = [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
        for child in node.children:
            if isinstance(child, Node):
                style = child.attributes.get("style")
                own = declared(style).get("visibility", "inherit") if style else "inherit"
                stack.append((child, depth + 1, hidden if own == "inherit" else own in ("hidden", "collapse")))
    return found


def _merged(node: Node) -> None:
    """Take up the children of elements that make no difference where they are."""
    if node.tag in INLINE:
        parts = []
        for child in node.children:
            same = isinstance(child, Node) and child.tag in INLINE and not {"x", "y"} & set(child.attributes) and visible(child)
            parts += child.children if same else [child]
        node.children = parts
    elif node.tag in PLAIN:
        seen = [c for c in node.children if (c.strip() if isinstance(c, str) else visible(c))]
        if len(seen) == 1 and isinstance(seen[0], Node) and seen[0].tag in PLAIN:
            node.children = seen[0].children


def _flat(node: Node) -> list:
    """What a node holds, without elements: blocks become lines."""
    out, stack = [], list(reversed(node.children))
    while stack:
        child = stack.pop()
        if isinstance(child, str) or child.tag in VOID:
            out.append(child)
        elif child.tag == "text":  # of a drawing, which shows no other
            label = Node("text", child.attributes)
            label.children = [c for c in _flat(child) if isinstance(c, str)]
            out.append(label)
        elif visible(child):
            line = [Node("br", {})] if child.tag in BLOCK else []
            stack += [*line, *reversed(child.children), *line]
    return out


def shown(root: Node) -> Node:
    """The tree without what is not shown and without depth that makes no difference."""
    found = _hide(root)
    deep = max(depth for _, depth in found) >= DEPTH
    if deep:
        for node, _ in reversed(found):
            _merged(node)
        stack = [(root, 0)]
        while stack:
            node, depth = stack.pop()
            if depth == DEPTH:
                node.children = _flat(node)
            else:
                stack += [(c, depth + 1) for c in node.children if isinstance(c, Node)]
    return root


def _nodes(node: Node, tag: str) -> Iterator[tuple[Node, bool]]:
    """Elements with a tag, in order, and whether a group around them is disabled."""
    for child in node.children:
        if isinstance(child, Node):
            if child.tag == tag:
                yield child, "disabled" in node.attributes and node.tag == "optgroup"
            else:
                yield from _nodes(child, tag)


def _plain(node: Node) -> str:
    parts = (c if isinstance(c, str) else _plain(c) if c.tag not in UNSEEN else "" for c in node.children)
    return SPACE.sub(" ", "".join(parts)).strip(" ")


def _option(node: Node) -> str:
    return (node.attributes.get("label") or "").strip() or _plain(node)


def _options(node: Node) -> list[str]:
    """The options that a form shows: all of a list box; of a menu the last selected, else the first that can be chosen."""
    if "multiple" in node.attributes or _number(node.attributes.get("size"), 1) > 1:
        return _listed(node)
    options = list(_nodes(node, "option"))
    chosen = [o for o, _ in options if "selected" in o.attributes][-1:]
    chosen = chosen or [o for o, off in options if not off and "disabled" not in o.attributes][:1]
    return [_option(o) for o in chosen]


def _listed(node: Node) -> list[str]:
    out = []
    for child in node.children:
        if isinstance(child, Node) and visible(child):
            if child.tag == "option":
                out.append(_option(child))
            else:
                out += [child.attributes.get("label") or ""] * (child.tag == "optgroup") + _listed(child)
    return out


def _drawn(node: Node) -> bool:
    a = node.attributes
    return visible(node) and a.get("display") != "none" and a.get("visibility") not in ("hidden", "collapse")


def _formula(node: Node) -> str:
    """The text of a formula; white space between its elements means nothing."""
    parts = []
    for child in node.children:
        if isinstance(child, str):
            parts.append(SPACE.sub(" ", child).strip(" "))
        elif child.tag not in UNDRAWN_MATH and _drawn(child):
            if child.tag in FOREIGN:
                parts.append(_shown(child))
            elif child.tag in TOKENS:
                parts.append(f" {_plain(child)} " if child.tag == "mtext" else _plain(child))
            else:
                parts.append(_formula(child))
    return (" " if node.tag in APART else "").join(filter(None, parts))


def _labels(node: Node, inside: bool = False) -> str:
    """The text of a drawing: only that of its text elements and of the HTML it holds."""
    parts = []
    for child in node.children:
        if isinstance(child, str):
            parts.append(child if inside else "")
        elif child.tag in UNDRAWN or not _drawn(child):
            continue
        elif child.tag == "foreignobject":
            parts.append(" " + "\n".join(_lines(child)) + " ")
        elif child.tag == "switch":
            holder = Node("g", {})
            holder.children = [
                c for c in child.children
                if isinstance(c, Node) and not {"requiredextensions", "systemlanguage"} & set(c.attributes)
            ][:1]
            parts.append(_labels(holder, inside))
        elif child.tag == "text":
            parts.append(" " + _labels(child, True) + " ")
        else:
            moved = inside and {"x", "y"} & set(child.attributes)
            parts.append(" " * bool(moved) + _labels(child, inside))
    return "".join(parts)


def _shown(node: Node) -> str:
    """The text of an element whose children do not simply follow each other."""
    if node.tag == "math":
        return _formula(node)
    if node.tag == "svg":
        return _labels(node) if _drawn(node) else ""
    if node.tag == "textarea":
        return _pre_text(node).strip("\n")
    return "\n".join(filter(None, _options(node)))


class _Layout:
    """Lines as they grow; `gap` asks for an empty line before the next text."""

    def __init__(self):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = False

    def text(self, words: str) -> None:
        self.inline.append(words)

    def end_line(self) -> None:
        line = SPACE.sub(" ", "".join(self.inline)).strip(" ")
        self.inline = []
        if line:
            self.add([line])

    def add(self, lines: list[str]) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines += lines

    def space(self) -> None:
        self.end_line()
        self.gap = True


def _lines(node: Node) -> list[str]:
    layout = _Layout()
    _fill(layout, node)
    layout.end_line()
    return layout.lines


def _fill(layout: _Layout, node: Node) -> None:
    for child in node.children:
        if isinstance(child, str):
            layout.text(child)
        elif not visible(child):
            continue
        elif child.tag == "br":
            layout.end_line()
        elif child.tag == "hr":
            layout.space()
        elif child.tag in BLOCK:
            _block(layout, child)
        elif child.tag in OWN_TEXT:
            shown = _shown(child)
            if child.tag == "textarea" or child.tag == "select" and "\n" in shown:
                layout.end_line()
                if shown.strip():
                    layout.add(shown.split("\n"))
            else:
                layout.text(shown)
        else:
            _fill(layout, child)


def _block(layout: _Layout, node: Node) -> None:
    spaced = node.tag in SPACED
    layout.space() if spaced else layout.end_line()
    if node.tag in LISTS:
        lines = _list_lines(node)
    elif node.tag == "table":
        lines = _table_lines(node)
    elif node.tag == "pre":
        lines = _pre_text(node).strip("\n").split("\n")
    else:
        lines = _lines(node)
        if node.tag == "dd":
            lines = [f"  {line}" if line else "" for line in lines]
    if any(lines):
        layout.add(lines)
    if spaced:
        layout.gap = True


def _pre_text(node: Node) -> str:
    parts = []
    for child in node.children:
        if isinstance(child, str):
            parts.append(child.replace("\r\n", "\n").replace("\r", "\n"))
        elif visible(child):
            parts.append("\n" if child.tag == "br" else _shown(child) if child.tag in OWN_TEXT else _pre_text(child))
    return "".join(parts)


def _number(text: str | None, otherwise: int) -> int:
    return int(text) if text and regex.fullmatch(r"-?[0-9]{1,9}", text) else otherwise


def _list_lines(node: Node) -> list[str]:
    out: list[str] = []
    place = _number(node.attributes.get("start"), 1)
    for child in node.children:
        if isinstance(child, str):
            words = SPACE.sub(" ", child).strip(" ")
            out += [words] if words else []
        elif visible(child):
            lines = [line for line in _lines_of(child) if line]
            if child.tag == "li":
                place = _number(child.attributes.get("value"), place)
                mark = f"{place}. " if node.tag == "ol" else "- "
                place += 1
                if lines:
                    out.append(mark + lines[0])
                    out += [" " * len(mark) + line for line in lines[1:]]
            else:
                out += ["  " + line for line in lines]
    return out


def _lines_of(node: Node) -> list[str]:
    """Lines of a node with its own layout."""
    layout = _Layout()
    if node.tag in BLOCK and node.tag != "li":
        _block(layout, node)
    elif node.tag in OWN_TEXT:
        holder = Node("span", {})
        holder.children = [node]
        _fill(layout, holder)
    else:
        _fill(layout, node)
    layout.end_line()
    return layout.lines


def _rows(node: Node) -> Iterator[tuple[str, list | str]]:
    """Parts of a table in order: ("row", cells) or ("text", lines) for a caption or stray content."""
    stray: list = []
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                stray.append(child)
        elif not visible(child):
            continue
        elif child.tag == "tr":
            yield "row", [c for c in child.children if isinstance(c, Node) and c.tag in ("td", "th") and visible(c)]
            loose = [c for c in child.children if (c.strip() if isinstance(c, str) else c.tag not in ("td", "th") and visible(c))]
            if loose:
                stray += loose
        elif child.tag in ("thead", "tbody", "tfoot"):
            yield from _rows(child)
        elif child.tag in ("td", "th"):
            yield "row", [child]
        else:
            stray.append(child)
    if stray:
        holder = Node("div", {})
        holder.children = stray
        yield "text", _lines(holder)


def _grid(rows: list[list[Node]]) -> list[list[list[str]]]:
    """The lines of the cells by row and column; columns that a cell from a row above reaches into are left free."""
    out: list[list[list[str]]] = []
    taken: dict[int, int] = {}  # column -> rows that a cell above still covers
    for cells in rows:
        line: list[list[str]] = []
        covered, taken = taken, {c: n - 1 for c, n in taken.items() if n > 1}
        for cell in cells:
            while len(line) in covered:
                line.append([])
            wide = min(max(_number(cell.attributes.get("colspan"), 1), 1), 1000)
            high = _number(cell.attributes.get("rowspan"), 1)
            high = min(high, 65534) if high > 0 else 65534  # 0: down to the last row
            for k in range(wide):
                if high > 1:
                    taken[len(line) + k] = high - 1
            line.append([x for x in _lines(cell) if x])
            line += [[]] * (wide - 1)
        out.append(line)
    return out


def _wide(text: str) -> int:
    """Columns that a text takes: two for a wide character, none for one that joins the one before."""
    if text.isascii():
        return len(text)
    return sum(0 if combining(c) else 1 + (east_asian_width(c) in "WF") for c in text)


def _table_lines(node: Node) -> list[str]:
    before: list[str] = []
    found: list[list[Node]] = []
    for kind, content in _rows(node):
        if kind == "text":
            before += content
        else:
            found.append(content)
    rows = _grid(found)
    widths: list[int] = []
    for cells in rows:
        widths += [0] * (len(cells) - len(widths))
        for i, lines in enumerate(cells):
            widths[i] = max([widths[i], *map(_wide, lines)])
    out = before
    for cells in rows:
        for k in range(max([0, *map(len, cells)])):
            parts = []
            for i, lines in enumerate(cells):
                text = lines[k] if k < len(lines) else ""
                parts.append(text + " " * (widths[i] - _wide(text)))
            out.append("  ".join(p for p, w in zip(parts, widths) if w).rstrip(" "))
    return out


def render(html: str | None) -> str | None:
    """The visible text of a page; NULL stays NULL, a page without text is empty."""
    if html is None:
        return None
    before = sys.getrecursionlimit()
    sys.setrecursionlimit(max(before, CALLS))
    try:
        return "\n".join(_lines(shown(tree(html))))
    finally:
        sys.setrecursionlimit(before)


def _render_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [render(html) for html in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.large_string()).cast(pa.string())],
            names=["page_id", "url", "text"],
        )


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_lines of every row of `pages`.

    A NULL page has NULL text and no lines. Repeated rows are rendered each; an empty table gives an
    empty result. Rows are independent: nothing is shuffled, and a lost task renders its rows again.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    texts = rows.mapInArrow(_render_rows, "page_id long, url string, text string")
    lines = F.when(F.length("text") > 0, F.size(F.split("text", "\n"))).otherwise(F.lit(0))
    return texts.withColumn("n_lines", lines.cast("long"))
