"""Layout-aware rendering of stored pages.

A light tree builder (implied end tags, void elements, visibility rules) that
emits every visible piece of text of ``<body>`` as *blocks* in layout order.
One block is one *line* of the page: the text between two neighbouring tags
other than the inline ones in :data:`INLINE`.

Everything here is plain Python that runs inside Arrow batches
(``mapInPandas``); nothing touches a SparkSession.

Defined results for odd input: ``None`` or an empty body give a page with no
blocks; text outside ``<body>`` is ignored when a body tag exists, else the
whole document counts; unclosed tags end with the document; entities are
decoded once; white space (with U+00A0 and U+3000) collapses to one blank.
"""

from __future__ import annotations

import re
from html import unescape

#: Tags that do not end a line.
INLINE = frozenset("a span b strong em i u sup sub code time img font small".split())
VOID = frozenset("br hr input meta link wbr col area base embed source track param".split())

_DROP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I
)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>")
_BODY = re.compile(r"<body\b[^>]*>", re.I)
_BODY_END = re.compile(r"</body\s*>", re.I)
_TITLE_TAG = re.compile(r"<title\b[^>]*>", re.I)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I)
_HIDDEN = re.compile(
    r"(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none|visibility\s*:\s*hidden|aria-hidden\s*=\s*[\"']?true", re.I
)

_CLOSES_P = frozenset(
    "address article aside blockquote center div dl fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split()
)
#: A start tag ends these open elements, up to the listed barriers.
_IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "table", "td"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}


class Page:
    """Blocks of one page in layout order and the tree they hang on.

    ``lines[i]`` is the text of block i, ``raw[i]`` its text before white space
    was collapsed (as is ``raw_title``), ``node[i]`` the element it stands in, ``linked[i]`` whether
    all of its text is inside anchors, ``big[i]`` whether an enlarging font
    opened it. ``tag``, ``parent``, ``attrs`` and ``first``/``last`` (range of
    blocks below) describe elements.
    """

    __slots__ = ("title", "raw_title", "lines", "raw", "node", "linked", "big", "after", "tag", "parent", "attrs", "hidden", "first", "last")

    def __init__(self) -> None:
        self.title = ""
        self.raw_title = ""
        self.lines: list[str] = []
        self.raw: list[str] = []
        self.node: list[int] = []
        self.linked: list[bool] = []
        self.big: list[bool] = []
        self.after: list[str] = []
        self.tag: list[str] = ["body"]
        self.parent: list[int] = [-1]
        self.attrs: list[str] = [""]
        self.hidden: list[bool] = [False]
        self.first: list[int] = [0]
        self.last: list[int] = [0]


def _find(html: str, tag: str, rx: re.Pattern[str]) -> tuple[int, int]:
    """Span of the first match of a tag's pattern, looked up by plain search; -1 without one."""
    at = html.find(tag)
    if at < 0:
        at = html.find(tag.upper())
    if at < 0 and tag not in html.lower():
        return -1, -1
    m = rx.match(html, at) if at >= 0 else None
    m = m or rx.search(html)
    return m.span() if m else (-1, -1)


def clean(text: str) -> str:
    """Entities decoded once, runs of white space one blank, ends trimmed."""
    if "&" in text:
        text = unescape(text)
    return " ".join(text.split())


def strip_dropped(html: str) -> str:
    """The document without comments, scripts, styles, templates and svg."""
    return _DROP.sub("", html)


def render(html: str | None) -> Page:
    """Build the tree and emit all text of the body as blocks."""
    page = Page()
    if not html:
        return page
    html = _DROP.sub("", html)
    start, end = _find(html, "<body", _BODY)
    t = _TITLE.search(html, max(0, _find(html, "<title", _TITLE_TAG)[0]), start if start >= 0 else len(html))
    if t:
        page.raw_title = t.group(1)
        page.title = clean(page.raw_title)
    if start >= 0:
        html = html[end:]
    start, _ = _find(html, "</body", _BODY_END)
    if start >= 0:
        html = html[:start]

    parts = _TAG.split(html)
    tag, parent, attrs, hidden, first, last = page.tag, page.parent, page.attrs, page.hidden, page.first, page.last
    lines, raws, nodes, linked, bigs, afters = page.lines, page.raw, page.node, page.linked, page.big, page.after
    stack = [0]
    buf = parts[0]
    plain = bool(buf and not buf.isspace())  # has text outside anchors
    big = False
    big_at = False
    anchors = 0
    prev = "body"

    for k in range(1, len(parts), 4):
        name = parts[k + 1]
        text = parts[k + 3]
        if name is None:  # a declaration: no element, but it ends the line
            name = "!"
        else:
            name = name.lower()
        if name in INLINE:
            if name == "a":
                anchors = 0 if parts[k] else 1
            elif name == "font" and not parts[k]:
                a = parts[k + 2]
                if "size" in a and ("size=5" in a or "size=6" in a or "size=7" in a or 'size="5' in a or 'size="6' in a or "size=+" in a):
                    big = True
            if text:
                if buf:
                    buf += text
                else:
                    buf = text
                if not text.isspace():
                    if not anchors:
                        plain = True
                    if big:
                        big_at = True
            continue
        if buf:
            s = unescape(buf) if "&" in buf else buf
            s = " ".join(s.split())
            if s:
                lines.append(s)
                raws.append(buf)
                nodes.append(stack[-1])
                linked.append(not plain)
                bigs.append(big_at)
                afters.append(prev)
        buf = text
        big = big_at = False
        anchors = 0
        plain = bool(text and not text.isspace())
        prev = name
        if name in VOID or name == "!":
            continue
        if parts[k]:  # end tag
            prev = "/" + name
            depth = len(stack) - 1
            while depth > 0:
                x = tag[stack[depth]]
                if x == name:
                    n = len(lines)
                    for e in stack[depth:]:
                        last[e] = n
                    del stack[depth:]
                    break
                if x == "table" or (x == "td" and name not in ("tr", "table", "tbody", "div", "center")):
                    break  # a stray end tag does not leave its cell
                depth -= 1
            continue
        if name in _CLOSES_P:
            depth = len(stack) - 1
            while depth > 0:
                x = tag[stack[depth]]
                if x == "p":
                    n = len(lines)
                    for e in stack[depth:]:
                        last[e] = n
                    del stack[depth:]
                    break
                if x in ("td", "th", "table", "li", "div", "button"):
                    break
                depth -= 1
        elif name in _IMPLIED:
            ends, barrier = _IMPLIED[name]
            depth = len(stack) - 1
            while depth > 0:
                x = tag[stack[depth]]
                if x in ends:
                    n = len(lines)
                    for e in stack[depth:]:
                        last[e] = n
                    del stack[depth:]
                    break
                if x in barrier:
                    break
                depth -= 1
        a = parts[k + 2]
        up = stack[-1]
        stack.append(len(tag))
        tag.append(name)
        parent.append(up)
        attrs.append(a)
        hidden.append(hidden[up] or bool(a and ("idden" in a or "isplay" in a) and _HIDDEN.search(a)))
        n = len(lines)
        first.append(n)
        last.append(n)
    if buf:
        s = unescape(buf) if "&" in buf else buf
        s = " ".join(s.split())
        if s:
            lines.append(s)
            raws.append(buf)
            nodes.append(stack[-1])
            linked.append(not plain)
            bigs.append(big_at)
            afters.append(prev)
    n = len(lines)
    for e in stack:
        last[e] = n
    return page


def to_text(page: Page, blocks: list[int] | None = None) -> str:
    """All visible text, or that of some blocks, as laid out: blank line between blocks, ``- ``
    before list items, cells of a table row side by side and padded to columns."""
    kept = None if blocks is None else frozenset(blocks)
    out: list[str] = []
    row: list[str] = []
    table: list[list[str]] = []
    row_node = table_node = -1

    def end_table() -> None:
        nonlocal row, table
        if row:
            table.append(row)
            row = []
        if table:
            width = [max((len(r[c]) for r in table if c < len(r)), default=0) for c in range(max(map(len, table)))]
            out.append("\n".join("  ".join(x.ljust(width[c]) for c, x in enumerate(r)).rstrip() for r in table))
            table = []

    tag, parent = page.tag, page.parent
    for i, s in enumerate(page.lines):
        e = page.node[i]
        if page.hidden[e] or kept is not None and i not in kept:
            continue
        x = e
        cell = -1
        while x > 0 and tag[x] != "table":
            if tag[x] in ("td", "th") and cell < 0:
                cell = x
            x = parent[x]
        if cell >= 0 and page.last[cell] - page.first[cell] == 1:  # a data cell, not a layout column
            r = parent[cell]
            if table_node != x:
                end_table()
                table_node, row_node = x, r
            elif r != row_node:
                table.append(row)
                row, row_node = [], r
            row.append(s)
            continue
        end_table()
        table_node = -1
        out.append("- " + s if tag[e] == "li" else s)
    end_table()
    text: list[str] = []
    for i, s in enumerate(out):
        if i:
            text.append("\n" if s.startswith("- ") and out[i - 1].startswith("- ") else "\n\n")
        text.append(s)
    return "".join(text)
