"""HTML extraction by layout-aware rendering.

A page is cut into tags and text, built into a tree and laid out as text. The tree builder knows
void elements, elements that close each other (p, li, dt/dd, table parts, options) and ignores
end tags that match nothing. Hidden parts are left out: head, scripts, styles, templates,
``hidden`` attributes and inline ``display:none`` / ``visibility:hidden``. Everything else is
emitted: blocks on lines of their own, paragraphs and headings set off by blank lines, list items
with their bullets or numbers and nested by indentation, tables as columns padded to the widest
cell, and preformatted text as it stands.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import pick

DEPTH = 200  # elements nested deeper become siblings, as bounded stacks in browsers do

# Element classes of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = set("head script style template noscript title meta link iframe noembed noframes audio video canvas svg math datalist object".split())
BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
summary table caption tbody thead tfoot tr td th ul""".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure menu dir".split())
CLOSES_P = BLOCK - set("body html li dd dt option optgroup caption tbody thead tfoot tr td th summary legend".split())
CLOSED_BY = {  # start tag -> (elements it closes, elements that stop the search)
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
}
SCOPE = set("table td th caption html body template button".split())  # an end tag does not reach beyond these

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f\v]+")
BREAK = "\0"


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)} if raw.strip(" /\n\t") else {}


def parse(page: str) -> Node:
    """The element tree of a page; text kids are plain strings."""
    root = Node("html", {})
    stack = [root]
    at = 0

    def text(raw: str) -> None:
        if raw:
            stack[-1].kids.append(html.unescape(raw.replace(BREAK, "")))

    def close(tags: set, stop: set) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return close(tags, stop) if tags != {"p"} else None
            if stack[i].tag in stop:
                return

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue  # comment, doctype, declaration
        if m[1]:
            if tag == "br":
                stack[-1].kids.append(Node("br", {}))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPE and tag not in SCOPE and tag not in ("tr", "tbody", "thead", "tfoot", "table"):
                    break
            continue
        if tag in ("html", "body"):
            if tag == "body":
                close({"head"}, set())
            (root.attrs if tag == "html" else {}).update(_attributes(m[3]))
            if tag == "html" or any(n.tag == "body" for n in stack):
                continue
        if tag in CLOSES_P:
            close({"p"}, SCOPE)
        if tag in CLOSED_BY:
            close(*CLOSED_BY[tag])
        if stack[-1].tag == "head" and tag not in HIDDEN and tag not in ("base", "head"):
            del stack[-1:]  # the first visible element ends an open head
        node = Node(tag, _attributes(m[3]))
        stack[-1].kids.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            stop = end.start() if end else len(page)
            if tag == "textarea":
                node.kids.append(html.unescape(page[at:stop]))
            at = end.end() if end else len(page)
        elif len(stack) < DEPTH:
            stack.append(node)
    return root


def _hidden(n: Node) -> bool:
    return (n.tag in HIDDEN or "hidden" in n.attrs or bool(_UNSEEN.search(n.attrs.get("style", "")))
            or n.tag == "input" and n.attrs.get("type", "text").lower() == "hidden")


class _Flow:
    """Lines of a block; runs of inline text are collapsed when a block or the end is met."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.run: list[str] = []
        self.gap = False

    def end_run(self) -> None:
        if self.run:
            for part in "".join(self.run).split(BREAK):
                part = _SPACE.sub(" ", part).strip(" ")
                if part:
                    self.put([part])
            self.run = []

    def put(self, lines: list[str]) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines += lines

    def block(self, lines: list[str], spaced: bool) -> None:
        self.end_run()
        if lines:
            self.gap |= spaced
            self.put(lines)
            self.gap = spaced


def _pre(node: Node) -> list[str]:
    out: list[str] = []

    def walk(n: Node) -> None:
        for k in n.kids:
            if isinstance(k, str):
                out.append(k)
            elif k.tag == "br":
                out.append("\n")
            elif not _hidden(k):
                walk(k)
    walk(node)
    lines = [x.rstrip() for x in "".join(out).replace("\r\n", "\n").replace("\r", "\n").split("\n")]
    while lines and not lines[0]:
        del lines[0]
    while lines and not lines[-1]:
        del lines[-1]
    return lines


def _items(node: Node) -> list[str]:
    out: list[str] = []
    number = int(node.attrs["start"]) if re.fullmatch(r"-?\d{1,9}", node.attrs.get("start", "")) else 1
    for k in node.kids:
        if isinstance(k, str) or k.tag != "li":
            loose = Node("div", {})
            loose.kids = [k]
            if isinstance(k, str) or not _hidden(k):
                out += ["  " + x if x else x for x in layout(loose)]
            continue
        if _hidden(k):
            continue
        mark = f"{number}. " if node.tag == "ol" else "- "
        number += 1
        lines = layout(k)
        pad = " " * len(mark)
        out += [((mark if i == 0 else pad) + x).rstrip() for i, x in enumerate(lines)]
    return out


def _table(node: Node) -> list[str]:
    head: list[str] = []
    rows: list[list[tuple[list[str], int]]] = []
    loose: list[str] = []

    def walk(n: Node) -> None:
        for k in n.kids:
            if isinstance(k, str):
                if k.strip():
                    loose.append(_SPACE.sub(" ", k).strip(" "))
            elif _hidden(k):
                continue
            elif k.tag == "caption":
                head.extend(layout(k))
            elif k.tag in ("thead", "tbody", "tfoot"):
                walk(k)
            elif k.tag in ("tr", "td", "th"):
                cells = [k] if k.tag != "tr" else [c for c in k.kids if not isinstance(c, str) and not _hidden(c)]
                loose.extend(_SPACE.sub(" ", c).strip(" ") for c in (k.kids if k.tag == "tr" else []) if isinstance(c, str) and c.strip())
                row = []
                for c in cells:
                    span = c.attrs.get("colspan", "1")
                    row.append((layout(c), min(int(span), 100) if re.fullmatch(r"[1-9]\d{0,3}", span) else 1))
                rows.append(row)
            else:
                loose.extend(layout(k))
    walk(node)
    width: dict[int, int] = {}
    for row in rows:
        col = 0
        for lines, span in row:
            if span == 1:
                width[col] = max(width.get(col, 0), max(map(len, lines), default=0))
            col += span
    out = loose + head
    for row in rows:
        for i in range(max((len(lines) for lines, _ in row), default=0)):
            col, line = 0, ""
            for lines, span in row:
                room = sum(width.get(c, 0) for c in range(col, col + span)) + 2 * (span - 1)
                line += (lines[i] if i < len(lines) else "").ljust(room) + "  "
                col += span
            out.append(line.rstrip())
    return out


def layout(node: Node) -> list[str]:
    """The lines of a block element."""
    if node.tag == "pre":
        return _pre(node)
    if node.tag in ("ul", "ol", "menu", "dir"):
        return _items(node)
    if node.tag == "table":
        return _table(node)
    flow = _Flow()

    def walk(n: Node) -> None:
        for k in n.kids:
            if isinstance(k, str):
                flow.run.append(k)
            elif _hidden(k):
                continue
            elif k.tag == "br":
                flow.run.append(BREAK)
            elif k.tag == "input":
                if k.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                    flow.run.append(" " + k.attrs.get("value", "") + " ")
            elif k.tag in BLOCK:
                lines = layout(k)
                if k.tag == "dd" or k.tag == "blockquote":
                    lines = ["  " + x if x else x for x in lines]
                flow.block(lines, k.tag in SPACED)
            elif k.tag in ("td", "th"):
                flow.run.append(" ")
                walk(k)
            else:
                walk(k)
    walk(node)
    flow.end_run()
    return flow.lines


def render(page: str | None) -> str:
    """Visible text of a page; '' for a null or empty page."""
    return "\n".join(layout(parse(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, text, n_lines, n_chars) of every row of ``pages`` (page_id, html).

    Null and empty pages have the empty text (0 lines). A page without tags is its own text with
    white space collapsed. Repeated rows repeat; an empty table gives no rows; other columns are
    ignored. A page is laid out whole in one task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                text = [render(p) for p in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(text, pa.string()),
                     pa.array([t.count("\n") + 1 if t else 0 for t in text], pa.int64()), pa.array([len(t) for t in text], pa.int64())],
                    ["page_id", "text", "n_lines", "n_chars"])
    return pick(pages, "page_id", "html").mapInArrow(run, "page_id long, text string, n_lines long, n_chars long")
