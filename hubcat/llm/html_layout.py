"""HTML extraction: a tree with implied tags, visibility rules, and the visible text laid out as blocks, lists and tables."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element names of the HTML standard, by their part in the layout.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
NEVER_SHOWN = {
    "head", "script", "style", "template", "noscript", "title", "iframe", "noembed", "noframes", "object", "audio", "video",
    "canvas", "svg", "math", "datalist", "param", "rp", "map",
}
SPACED = {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "blockquote", "pre", "figure", "hr", "fieldset", "menu", "dir",
    "listing", "xmp",
}
BLOCK = SPACED | {
    "address", "article", "aside", "body", "caption", "center", "dd", "details", "dialog", "div", "dt", "figcaption", "footer", "form",
    "header", "hgroup", "html", "legend", "li", "main", "nav", "option", "optgroup", "search", "section", "summary", "tr", "tbody", "thead",
    "tfoot",
}
TABLE_PARTS = {"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}
ROW_GROUPS = {"thead", "tbody", "tfoot"}
LISTS = {"ul", "ol", "menu", "dir"}
#: An open element of the first kind ends when one of the second kind begins.
ENDED_BY = {
    "p": SPACED | {
        "address", "article", "aside", "center", "details", "dialog", "div", "dd", "dt", "figcaption", "footer", "form", "header", "hgroup",
        "li", "main", "nav", "search", "section", "summary"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option", "optgroup"},
    "optgroup": {"optgroup"},
    "td": {"td", "th", "tr", "tbody", "thead", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "thead", "tfoot"},
    "tr": {"tr", "tbody", "thead", "tfoot"},
    "caption": {"tr", "td", "th", "tbody", "thead", "tfoot", "colgroup"},
    "colgroup": {"tr", "td", "th", "tbody", "thead", "tfoot", "colgroup"},
    "tbody": {"tbody", "thead", "tfoot"},
    "thead": {"tbody", "thead", "tfoot"},
    "tfoot": {"tbody", "thead", "tfoot"},
    "rt": {"rt", "rp"},
    "rp": {"rt", "rp"},
}
#: No implied end reaches out of these.
SCOPES = {
    "p": {"table", "td", "th", "caption", "button", "html", "body"},
    "li": {"ul", "ol", "menu", "dir", "table", "td", "th"},
    "dt": {"dl", "table", "td", "th"},
    "dd": {"dl", "table", "td", "th"},
    "option": {"select", "datalist"},
    "optgroup": {"select", "datalist"},
    "rt": {"ruby"},
    "rp": {"ruby"},
}
#: No end tag reaches out of these, but for those of tables and their parts.
P_ENDS = {"table", "td", "th", "caption"}
HEAD_ONLY = {"base", "link", "meta", "title", "style", "script", "noscript", "template", "head", "html"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</?[a-zA-Z][^\s/>]*(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>\"']+)))?")
_HIDDEN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b")
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(\w+)")
_BLANKS = re.compile(r"[ \t\n\f\r]+")


_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_BRACE = re.compile(r"[{}]")
_COMPOUND = re.compile(r"(?:\*|[a-z][\w-]*)?(?:[.#][\w-]+)*")
_PART = re.compile(r"[.#]?[\w-]+")
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?\s*(?=;|$)")
_SCREEN = re.compile(r"@media\s+(?:only\s+)?(?:screen|all)\s*")
#: Which open elements end when an element of this name begins, and what their ends do not reach out of.
_ENDS = {name: [(open_, SCOPES.get(open_, {"table"})) for open_, by in ENDED_BY.items() if name in by] for name in set().union(*ENDED_BY.values())}


class Node:
    """An element: its attributes, and texts and elements in order."""

    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def tokens(source: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """(kind, name or text, attributes); kind is "text", "open" or "close"."""
    at = 0
    while at < len(source):
        found = _TOKEN.search(source, at)
        if found is None or found.start() > at:
            yield "text", html.unescape(source[at:found.start() if found else len(source)]), {}
        if found is None:
            return
        at, piece = found.end(), found.group()
        if piece[1] in "!?":
            continue
        name = _NAME.match(piece).group(1).lower()
        if piece[1] == "/":
            yield "close", name, {}
            continue
        inner = piece[1 + len(name):].rstrip(">")
        yield "open", name, {k.lower(): html.unescape(a or b or c) for k, a, b, c in reversed(_ATTRIBUTE.findall(inner))}
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, at)
            stop = end.start() if end else len(source)
            body = source[at:stop]
            yield "text", html.unescape(body) if name in ("title", "textarea") else body, {}
            at = stop
        elif name == "plaintext":
            yield "text", source[at:], {}
            return


def build(source: str, styles: list[str] | None = None) -> Node:
    """The tree of a page. Missing end tags are implied, stray ones passed over; style sheets for a screen go to ``styles``.

    ``open_at`` has the depths of the open elements by name, so that an end costs what it closes, however deep the page is. ``reach``
    counts, for each open element, the <p> that a </p> inside it could end.
    """
    root = Node("html", {})
    stack, reach, open_at = [root], [0], {"html": [0]}

    def push(node: Node) -> None:
        open_at.setdefault(node.tag, []).append(len(stack))
        stack.append(node)
        reach.append(0 if node.tag in P_ENDS else reach[-1] + (node.tag == "p"))

    def cut(depth: int) -> None:
        for node in stack[depth:]:
            open_at[node.tag].pop()
        del stack[depth:], reach[depth:]

    def end(tag: str, within: set[str]) -> None:
        depth = (open_at.get(tag) or [0])[-1]
        if depth and not any(open_at.get(other) and open_at[other][-1] > depth for other in within):
            cut(depth)

    for kind, name, attributes in tokens(source):
        if kind == "text":
            if stack[-1].tag == "head" and name.strip():
                cut(len(stack) - 1)
            elif stack[-1].tag == "style" and styles is not None and stack[-1].attributes.get("media", "all").strip().lower() in ("", "all", "screen"):
                styles.append(name)
            stack[-1].children.append(name)
        elif kind == "close":
            if name == "p" and not reach[-1]:
                stack[-1].children.append(Node("p", {}))
            elif name == "br":
                stack[-1].children.append(Node("br", {}))
            else:
                end(name, set() if name == "table" else {"table"} if name in TABLE_PARTS else P_ENDS)
        else:
            if name in ("html", "body") and any(n.tag == name for n in stack[:3]):
                continue
            if stack[-1].tag == "head" and name not in HEAD_ONLY:
                cut(len(stack) - 1)
            for open_, within in _ENDS.get(name, ()):
                end(open_, within)
            if name in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                row = Node("tr", {})
                stack[-1].children.append(row)
                push(row)
            node = Node(name, attributes)
            stack[-1].children.append(node)
            if name not in VOID:
                push(node)
    return root


class Sheet:
    """What a page's own style sheets say about ``display`` and ``visibility``.

    Read are rules whose selectors are an element's name, classes and ids in one (``p``, ``.a``, ``div.a#b``), also inside @media for
    screens; later, more specific and important ones win. Selectors with relations, attributes or states, and other at-rules, are
    passed over: what they would hide is shown.
    """

    def __init__(self, sheets: list[str]):
        found: dict[tuple[str, tuple[str, ...]], tuple] = {}
        order = count()
        work = [_COMMENT.sub("", sheet).lower() for sheet in reversed(sheets)]
        while work:
            text = work.pop()
            at = 0
            while (brace := text.find("{", at)) >= 0:
                start = text[at:brace].rsplit(";", 1)[-1].strip()
                depth, stop = 0, len(text)
                for mark in _BRACE.finditer(text, brace):
                    depth += 1 if mark.group() == "{" else -1
                    if not depth:
                        stop = mark.start()
                        break
                body, at = text[brace + 1:stop], stop + 1
                if _SCREEN.fullmatch(start + " "):
                    work += [text[at:], body]
                    break
                if not start.startswith("@"):
                    self._add(found, order, start.split(","), body)
        counts = Counter(part for _, parts in found for part in parts)
        self.rules: dict[str, list[tuple]] = {}
        for (name, parts), said in found.items():
            self.rules.setdefault(min(parts, key=counts.__getitem__), []).append((name, frozenset(parts), said))

    @staticmethod
    def _add(found: dict, order: Iterator[int], selectors: list[str], body: str) -> None:
        stated = _DECLARED.findall(body)
        for selector in selectors if stated else ():
            selector = selector.strip()
            if not selector or not _COMPOUND.fullmatch(selector):
                continue
            parts = tuple(sorted(set(_PART.findall(selector)))) or ("*",)
            weight = (sum(p[0] == "#" for p in parts), sum(p[0] == "." for p in parts), len(parts))
            for name, value, important in stated:
                rank = (bool(important), weight, next(order))
                # A later rule of the same selector takes the place of an earlier one, but not of an important one.
                old = found.pop((name, parts), None)
                found[name, parts] = old if old and old[0][0] > rank[0] else (rank, value)

    def says(self, node: Node, name: str) -> tuple[str | None, bool]:
        """The value of a property for an element, and whether it beats the element's own style."""
        if not self.rules:
            return None, False
        own = {node.tag, "*"}
        own.update("." + c for c in node.attributes.get("class", "").lower().split())
        if "id" in node.attributes:
            own.add("#" + node.attributes["id"].strip().lower())
        best = None
        for key in own:
            for of, parts, said in self.rules.get(key, ()):
                if of == name and parts <= own and (best is None or said[0] > best[0]):
                    best = said
        return (None, False) if best is None else (best[1], best[0][0])


def _shown(node: Node, sheet: Sheet) -> bool:
    """Whether an element takes part in the layout at all."""
    given = node.attributes
    if node.tag in NEVER_SHOWN or "hidden" in given and given["hidden"].lower() != "until-found":
        return False
    if node.tag == "dialog" and "open" not in given or node.tag == "input" and given.get("type", "").lower() == "hidden":
        return False
    own = given.get("style", "").lower()
    value, important = sheet.says(node, "display")
    if value is not None and (important or "display" not in own):
        return value != "none"
    return not _HIDDEN.search(own)


class Page:
    """Lines of text under way, with the blank lines that blocks ask for."""

    def __init__(self, indent: str = ""):
        self.lines: list[str] = []
        self.line, self.space, self.gap, self.indent, self.mark = "", False, 0, indent, ""

    def write(self, text: str, kept: bool) -> None:
        if kept:
            first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._put(first)
            for line in rest:
                self.end_line(True)
                self._put(line)
            return
        words = _BLANKS.sub(" ", text)
        if not words.strip(" "):
            self.space |= bool(words) and bool(self.line)
            return
        joined = (words[0] == " " or self.space) and bool(self.line)
        self._put(" " * joined + words.strip(" "))
        self.space = words[-1] == " "

    def _put(self, text: str) -> None:
        if not text:
            return
        if not self.line:
            if self.gap and self.lines:
                self.lines += [""] * (self.gap - 1)
            self.gap = 0
            self.line = self.indent[:len(self.indent) - len(self.mark)] + self.mark
            self.mark = ""
        self.line += text

    def end_line(self, even_empty: bool = False) -> None:
        if self.line or even_empty:
            self.lines.append(self.line.rstrip())
        self.line, self.space = "", False

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


def _span(node: Node, name: str, least: int, most: int) -> int:
    """colspan or rowspan of a cell; 1 where it is missing or no number of at least ``least``."""
    given = node.attributes.get(name, "1")
    n = min(int(given.lstrip("0")[:9] or "0"), most) if given.isascii() and given.isdigit() else 1
    return n if n >= least else 1


def _placed(rows: list[list[tuple[str, int, int]]]) -> list[list[tuple[int, str, int]]]:
    """(column, text, colspan) of the cells of a row group; columns that a cell of an earlier row still holds are passed over."""
    placed, held = [], {}
    for k, row in enumerate(rows):
        at, cells = 0, []
        for text, span, down in row:
            while held.get(at, -1) >= k:
                at += 1
            cells.append((at, text, span))
            # rowspan 0 reaches to the end of the group.
            last = k + down - 1 if down else len(rows)
            if last > k:
                held.update((c, max(last, held.get(c, -1))) for c in range(at, at + span))
            at += span
        placed.append(cells)
    return placed


def _table(groups: list[list[list[tuple[str, int, int]]]]) -> list[str]:
    """Cells in columns of one width, two blanks apart; a cell's lines stay in its column. Blank lines go at the ends of a row only."""
    rows = [row for group in groups for row in _placed(group)]
    widths: dict[int, int] = {}
    for row in rows:
        for at, text, span in row:
            if span == 1:
                widths[at] = max(widths.get(at, 0), *map(len, text.split("\n")))
    lines = []
    for row in rows:
        cells = [(at, text.split("\n"), span) for at, text, span in row]
        made = []
        for k in range(max((len(t) for _, t, _ in cells), default=0)):
            reached, line = 0, ""
            for at, text, span in cells:
                line += " " * sum(widths.get(c, 0) + 2 for c in range(reached, at))
                width = sum(widths.get(c, 0) for c in range(at, at + span)) + 2 * (span - 1)
                line += (text[k] if k < len(text) else "").ljust(width) + "  "
                reached = at + span
            made.append(line.rstrip())
        shown = [k for k, line in enumerate(made) if line]
        if shown:
            lines += made[shown[0]:shown[-1] + 1]
    return lines


def render(root: Node, sheet: Sheet | None = None) -> str:
    """The visible text of a tree, without recursion: pages nest as deep as they like."""
    pages, sheet = [Page()], sheet or Sheet([])
    tables: list[list[list[list[tuple[str, int, int]]]]] = []
    counters: list[int | None] = []
    work: list[tuple] = [("enter", root, True, False)]
    while work:
        step, node, visible, kept = work.pop()
        page = pages[-1]
        if step == "leave":
            _leave(node, pages, tables, counters)
            continue
        if isinstance(node, str):
            if visible:
                page.write(node, kept)
            continue
        if not _shown(node, sheet):
            continue
        stated = _VISIBILITY.search(node.attributes.get("style", "").lower())
        value, important = sheet.says(node, "visibility")
        value = stated.group(1) if stated and not (value and important) else value
        visible = value in ("visible", "inherit", "initial") if value else visible
        tag, children = node.tag, node.children
        if tag == "br":
            page.end_line(True)
            continue
        if tag in VOID and tag != "hr":
            if tag == "wbr" or not visible:
                continue
            shown = node.attributes.get("alt", "") if tag in ("img", "area") else ""
            page.write(shown, False)
            continue
        if tag == "details" and "open" not in node.attributes:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        _enter(node, pages, tables, counters)
        work.append(("leave", node, visible, kept))
        kept = kept or tag in ("pre", "listing", "xmp", "textarea")
        if tag in ("pre", "listing") and children and isinstance(children[0], str) and children[0][:1] == "\n":
            children = [children[0][1:], *children[1:]]
        if tag in ("table", "tbody", "thead", "tfoot", "tr"):
            children = [c for c in children if not isinstance(c, str) or c.strip()]
        work += [("enter", c, visible, kept) for c in reversed(children)]
    return pages[0].text()


def _enter(node: Node, pages: list[Page], tables: list, counters: list) -> None:
    tag, page = node.tag, pages[-1]
    if tag in ROW_GROUPS and tables:
        tables[-1].append([])
    if tag == "table":
        page.block(2)
        tables.append([[]])
    elif tag == "tr" and tables:
        tables[-1][-1].append([])
    elif tag in ("td", "th") and tables:
        if not tables[-1][-1]:
            tables[-1][-1].append([])
        pages.append(Page())
    elif tag in BLOCK:
        nested = tag in LISTS and bool(counters)
        page.block(2 if tag in SPACED and not nested else 1)
        if tag in LISTS:
            start = node.attributes.get("start", "1")
            counters.append(None if tag != "ol" else int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1)
        elif tag == "li":
            mark = "- "
            if counters and counters[-1] is not None:
                mark = f"{counters[-1]}. "
                counters[-1] += 1
            page.indent += " " * len(mark)
            page.mark = mark
            node.attributes["\0width"] = str(len(mark))
        elif tag in ("blockquote", "dd"):
            page.indent += "  "


def _leave(node: Node, pages: list[Page], tables: list, counters: list) -> None:
    tag = node.tag
    if tag in ROW_GROUPS and tables:
        tables[-1].append([])
    if tag == "table" and tables:
        lines, page = _table(tables.pop()), pages[-1]
        page.end_line()
        for line in lines:
            page.write(line, True)
            page.end_line(True)
        page.block(2)
    elif tag in ("td", "th") and len(pages) > 1 and tables:
        if not tables[-1][-1]:
            tables[-1][-1].append([])
        tables[-1][-1][-1].append((pages.pop().text(), _span(node, "colspan", 1, 1000), _span(node, "rowspan", 0, 65534)))
    elif tag in BLOCK:
        page = pages[-1]
        page.block(2 if tag in SPACED and not (tag in LISTS and len(counters) > 1) else 1)
        if tag in LISTS and counters:
            counters.pop()
        elif tag == "li":
            width = int(node.attributes.pop("\0width"))
            page.indent, page.mark = page.indent[:len(page.indent) - width], ""
        elif tag in ("blockquote", "dd"):
            page.indent = page.indent[:-2]


def visible_text(source: str) -> str:
    """What a reader of the page sees, as text."""
    styles: list[str] = []
    root = build(source, styles)
    return render(root, Sheet(styles))


def extract(pages: DataFrame, html_column: str = "html", page_id: str = "page_id") -> DataFrame:
    """One row per page: page_id and text, all its visible text.

    Blocks stand on lines of their own, paragraphs, headings, lists and tables between blank
    lines; list items have their marks and indents, table cells their columns. Null and empty
    pages give empty text; rows that repeat an id come back each. Of a page's own style sheets the simple rules
    that hide are read (see ``Sheet``), of others none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(source or "") for source in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])
    return pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{html_column}`").alias("html")).mapInArrow(
        run, f"page_id {dict(pages.dtypes)[page_id]}, text string")
