"""Markup shown as text in the main body of pages, and clean text without it.

Method: gradient-boosted trees over DOM nodes. Elements and the text blocks
below them are nodes with features of their subtree (text and link density,
lines, sentence ends), their attribute tokens, depth and siblings; a softmax
ensemble gives each node a probability of being all content, all furniture or
mixed. Hierarchical decoding then picks the most probable labelling of the
whole tree in which no descendant contradicts its ancestor: below a content
node everything is content, below a furniture node everything is furniture.
The blocks labelled content are searched for markup of four kinds.

The ensemble is fitted on a bounded sample of pages (:data:`SAMPLE_PAGES`),
labelled by the layout rules of :mod:`.mainbody`. Pages in which no visible
line has a character sequence of any markup can hold no case and skip the trees.

Defined results: pages without text have no markup; code inside ``pre`` is
content but never a case; a page may show several kinds.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np

from .html import Page
from .mainbody import furniture, headline, with_headline

KINDS = ("html", "markdown", "wiki", "latex")
#: Most pages the node classifier is fitted on.
SAMPLE_PAGES = 400
#: Bytes of the longest body in that sample.
SAMPLE_BYTES = 1 << 18
TREES = 24
DEPTH = 4
RATE = 0.3
BINS = 24

# ----------------------------------------------------------------- markup grammars

_HTML = re.compile(
    r"</?(?:p|br|hr|li|ul|ol|dl|dt|dd|table|thead|tbody|tr|td|th|div|span|a|b|i|u|s|em|strong|font|h[1-6]|blockquote|pre|code|img|sub|sup|center|section|article|figure|figcaption)"
    r"(?:\s+[\w:-]+(?:\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s<>\"']+))?)*\s*/?>"
    r"|&(?:nbsp|amp|lt|gt|quot|apos|ldquo|rdquo|lsquo|rsquo|hellip|mdash|ndash|[a-zA-Z]{1,6}(?:grave|acute|circ|tilde|uml|cedil|ring)|#\d{2,6}|#x[0-9a-fA-F]{2,5});|<!--"
)
_MARKDOWN = re.compile(
    r"^#{2,6}\s+\S|(?<![\w*])\*{2,3}(?=[^\s*])[^*\n]{1,200}(?<=[^\s*])\*{2,3}|(?<=\w)\*{2,3}(?=[^\s*])[^*\n]{1,80}(?<=[^\s*])\*{2,3}|(?<![\w_])__(?=[^\s_])[^_\n]{1,120}(?<=[^\s_])__(?![\w_])"
    r"|`[^`\n]{1,120}`|^\s*(?:```|~~~)|!\[[^\]\n]{0,200}\]\([^()\s]+\)|(?<!\[)\[[^\[\]\n]{1,200}\]\((?:https?:|/|#|mailto:|\.)[^()\s]*\)|^\|?(?:\s*:?-{3,}:?\s*\|)+(?:\s*:?-{3,}:?\s*)?$|^\|(?:[^|\n]+\|){2,}$|~~[^~\s][^~\n]*~~"
)
_WIKI = re.compile(
    r"\[\[[^\[\]\n]{1,200}\]\]|\{\{[^{}\n|]{1,60}\|[^{}]*\}\}|\{\{[^{}\n|]{1,60}\|[^{}]*$|^\{\||^\|-+\s*$|^\|\}|(?<!')'''(?!')[^'\n]{1,200}'''(?!')|(?<!')''(?!')[^'\n]{1,200}''(?!')|^={2,6}\s*[^=\s][^=]*={2,6}\s*$"
    r"|^[|!].*(?:\|\||!!)|</?(?:ref|nowiki|gallery)\b[^<>]*>|^\s*(?:#REDIRECT|\[\[Category:)|__(?:TOC|NOTOC)__"
)
_LATEX = re.compile(
    r"\\(?:begin|end|(?:sub)*section\*?|chapter\*?|paragraph|textbf|textit|texttt|emph|underline|cite[pt]?|ref|label|footnote|caption|includegraphics|href|url|frac|sqrt|sum|int|times|cdot|alpha|beta|gamma|mu|leq|geq|pm|hline|mathrm|mathbf|left|right)(?![A-Za-z])\s*[\[{*\\$ ]?"
    r"|\\item(?![A-Za-z])|\$\$[^$\n]+\$\$|\$[^$\n]*(?:\\[a-zA-Z]+|[\^_]\{)[^$\n]*\$|(?:\s&\s.*)?\\\\\s*$"
)
_GRAMMAR = dict(zip(KINDS, (_HTML, _MARKDOWN, _WIKI, _LATEX)))
#: Without one of these no grammar matches.
_SCREEN = re.compile(r"[<\\`\[{|~$&]|\*\*|__|''|==|##|--")


#: Lines opened by a plus sign that make a list where nothing else shows markup.
MIN_ITEMS = 2


def kinds_in(lines: list[str]) -> list[str]:
    """Kinds of markup that lines of a page show."""
    joined = "\n".join(lines)
    if not _SCREEN.search(joined):
        return ["markdown"] if joined.count("+ ") >= MIN_ITEMS and sum(s.startswith("+ ") for s in lines) >= MIN_ITEMS else []
    found = [k for k in KINDS if any(_GRAMMAR[k].search(s) for s in lines)]
    if not found and sum(s.startswith("+ ") for s in lines) >= MIN_ITEMS:
        found = ["markdown"]
    return found


# -------------------------------------------------------------------- tree features

_CONTENT_TOKEN = re.compile(r"(?:^|[\s\"'=_-])(?:content|article|entry|post|main|body|detail|text|story|hentry)(?=$|[\s\"'_-])", re.I)
_SIDE_TOKEN = re.compile(
    r"(?:^|[\s\"'=_-])(?:share|social|related|comments?|author|byline|meta|breadcrumb|path|cookie|gdpr|notice|newsletter|sidebar|right|widget|menu|nav|footer|bottom|top|copyright|colophon|ads?|box|note|more)(?=$|[\s\"'_-])",
    re.I,
)
_DIGIT = re.compile(r"[0-9]")
_END = re.compile(r"[.。!?!?…:]['\")”’»]*$")
_SIDE = frozenset("nav aside footer header form button noscript center".split())
_ROOT = frozenset("main article section body".split())
N_FEATURES = 26
CONTENT, FURNITURE, MIXED = 0, 1, 2


def tree_of(page: Page) -> tuple[list[int], list[list[int]]]:
    """(parent of each node, children): elements first, then one leaf a block."""
    parent = list(page.parent) + list(page.node)
    children: list[list[int]] = [[] for _ in parent]
    for n, p in enumerate(parent):
        if p >= 0:
            children[p].append(n)
    return parent, children


def features(page: Page, head: int) -> np.ndarray:
    """Feature rows of all nodes of a page in the order of :func:`tree_of`."""
    lines = page.lines
    n_el, n = len(page.tag), len(page.lines)
    size = np.fromiter(map(len, lines), float, n)
    linked = np.array(page.linked, float)
    ends = np.fromiter((bool(_END.search(s)) for s in lines), float, n)
    furn = np.fromiter((bool(furniture(s)) for s in lines), float, n)
    digits = np.fromiter((len(_DIGIT.findall(s)) for s in lines), float, n)
    stats = np.cumsum(np.vstack([np.zeros(6), np.column_stack([np.ones(n), size, size * linked, ends, furn, digits])]) if n else np.zeros((1, 6)), axis=0)
    first = np.concatenate([np.array(page.first), np.arange(n)]).astype(int)
    last = np.concatenate([np.array(page.last), np.arange(1, n + 1)]).astype(int)
    below = stats[last] - stats[first]
    total = stats[-1]
    parent, children = tree_of(page)
    depth = np.zeros(n_el + n)
    order = np.zeros(n_el + n)
    siblings = np.ones(n_el + n)
    alike = np.ones(n_el + n)
    names = page.tag + ["#"] * n
    for p, kids in enumerate(children):
        k = len(kids)
        if not k:
            continue
        kids_in_order = sorted(kids, key=lambda c: (first[c], c)) if p < n_el else kids
        count: dict[str, int] = {}
        for c in kids:
            count[names[c]] = count.get(names[c], 0) + 1
        for i, c in enumerate(kids_in_order):
            depth[c] = depth[p] + 1
            order[c] = i / k
            siblings[c] = k
            alike[c] = count[names[c]] / k
    # what an element says of itself, then of the elements above it; a block repeats its element
    tag_side = [t in _SIDE for t in page.tag]
    token_side = [bool(a and _SIDE_TOKEN.search(a)) for a in page.attrs]
    token_content = [bool(a and _CONTENT_TOKEN.search(a)) for a in page.attrs]
    side = [False] * n_el
    for e in range(n_el):
        side[e] = tag_side[e] or token_side[e] or (e > 0 and side[page.parent[e]])
    node = np.array(page.node, int)

    def both(values: list) -> np.ndarray:
        x = np.array(values, float)
        return np.concatenate([x, x[node]]) if n else x

    rows = np.maximum(below[:, 0], 1)
    at = first.astype(float)
    has_head = ((first <= head) & (head < last)).astype(float) if head >= 0 else np.zeros(n_el + n)
    total_lines = max(1.0, total[0])
    return np.column_stack([
        np.concatenate([np.zeros(n_el), np.ones(n)]),
        depth,
        below[:, 0],
        below[:, 1],
        below[:, 1] / rows,
        below[:, 2] / np.maximum(below[:, 1], 1),
        below[:, 3] / rows,
        below[:, 4] / rows,
        below[:, 5] / np.maximum(below[:, 1], 1),
        below[:, 1] / max(1.0, total[1]),
        at / total_lines,
        (total_lines - last) / total_lines,
        siblings,
        order,
        alike,
        has_head,
        (at - head) / total_lines if head >= 0 else np.zeros(n_el + n),
        (first == head).astype(float),
        both(tag_side),
        both([t in _ROOT for t in page.tag]),
        both([t in ("p", "li", "td", "blockquote", "figcaption", "pre") for t in page.tag]),
        both([t in ("h1", "h2", "h3", "h4") for t in page.tag]),
        both(token_content),
        both(token_side),
        both(side),
        _since_closing(page, head, first),
    ])


def _since_closing(page: Page, head: int, first: np.ndarray) -> np.ndarray:
    """1 for nodes after the first closing furniture line that follows the headline."""
    from .mainbody import CLOSING

    cut = len(page.lines) + 1
    for i in range(head + 1 if head >= 0 else 0, len(page.lines)):
        if furniture(page.lines[i]) in CLOSING:
            cut = i
            break
    return (first >= cut).astype(float)


def labels(page: Page, body: list[int]) -> np.ndarray:
    """Label of each node from the blocks that are content."""
    n = len(page.lines)
    inside = np.zeros(n + 1)
    inside[np.array(body, int) + 1] = 1
    c = np.cumsum(inside)
    first = np.concatenate([np.array(page.first), np.arange(n)]).astype(int)
    last = np.concatenate([np.array(page.last), np.arange(1, n + 1)]).astype(int)
    k = c[last] - c[first]
    return np.where(k == 0, FURNITURE, np.where(k == last - first, CONTENT, MIXED))


# ------------------------------------------------------------- gradient-boosted trees


class Trees:
    """Softmax gradient boosting with histogram splits, in numpy."""

    def __init__(self, classes: int = 3) -> None:
        self.classes = classes
        self.trees: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
        self.edges: list[np.ndarray] = []
        self.prior = np.zeros(classes)

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)]).astype(np.int16)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        share = np.bincount(y, minlength=self.classes) + 1.0
        self.prior = np.log(share / share.sum())
        # nodes of one template look alike: equal rows are grown once, with their number as weight
        alike, weight = np.unique(np.column_stack([self._bin(x), y.astype(np.int16)]), axis=0, return_counts=True)
        b, y = alike[:, :-1], alike[:, -1]
        columns = np.ascontiguousarray(b.T).astype(np.intp)
        f = np.tile(self.prior, (len(y), 1))
        onehot = np.eye(self.classes)[y]
        for _ in range(TREES):
            e = np.exp(f - f.max(1, keepdims=True))
            p = e / e.sum(1, keepdims=True)
            group = []
            for c in range(self.classes):
                tree = self._grow(b, columns, weight * (onehot[:, c] - p[:, c]), weight * p[:, c] * (1 - p[:, c]))
                group.append(tree)
                f[:, c] += RATE * self._apply(tree, b)
            self.trees.append(group)
        return self

    @staticmethod
    def _grow(b: np.ndarray, columns: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(feature, threshold, leaf value) of a full binary tree; feature -1 does not split."""
        inner = 2**DEPTH - 1
        feature, threshold = np.full(inner, -1), np.zeros(inner, int)
        at = np.zeros(len(g), int)
        width = BINS + 2
        for level in range(DEPTH):
            lo = 2**level - 1
            k = 2**level
            where = at - lo
            best = np.zeros(k)
            gt = np.bincount(where, g, k)
            ht = np.bincount(where, h, k)
            base = where * width
            for j, column in enumerate(columns):
                key = base + column
                gl = np.cumsum(np.bincount(key, g, k * width).reshape(k, width), axis=1)[:, :-1]
                hl = np.cumsum(np.bincount(key, h, k * width).reshape(k, width), axis=1)[:, :-1]
                gr, hr = gt[:, None] - gl, ht[:, None] - hl
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - (gt**2 / (ht + 1))[:, None]
                gain[(hl < 1) | (hr < 1)] = 0
                t = gain.argmax(1)
                v = gain[np.arange(k), t]
                better = v > best + 1e-9
                best[better] = v[better]
                feature[lo : lo + k][better] = j
                threshold[lo : lo + k][better] = t[better]
            fj = feature[at]
            go = (fj >= 0) & (b[np.arange(len(g)), np.maximum(fj, 0)] > threshold[at])
            at = 2 * at + 1 + go
        leaf = at - inner
        value = np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)
        return feature, threshold, value

    @staticmethod
    def _apply(tree: tuple[np.ndarray, np.ndarray, np.ndarray], b: np.ndarray) -> np.ndarray:
        feature, threshold, value = tree
        at = np.zeros(len(b), int)
        rows = np.arange(len(b))
        for _ in range(DEPTH):
            fj = feature[at]
            go = (fj >= 0) & (b[rows, np.maximum(fj, 0)] > threshold[at])
            at = 2 * at + 1 + go
        return value[at - (2**DEPTH - 1)]

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        b = self._bin(x)
        f = np.tile(self.prior, (len(x), 1))
        for group in self.trees:
            for c, tree in enumerate(group):
                f[:, c] += RATE * self._apply(tree, b)
        f -= f.max(1, keepdims=True)
        return f - np.log(np.exp(f).sum(1, keepdims=True))


def fit(pages: list[Page]) -> Trees:
    """Node classifier from pages labelled by the layout rules."""
    xs, ys = [], []
    for p in pages[:SAMPLE_PAGES]:
        if p.lines:
            head, body = with_headline(p)
            xs.append(features(p, head))
            ys.append(labels(p, body))
    if not xs:
        return Trees().fit(np.zeros((1, N_FEATURES)), np.array([FURNITURE]))
    return Trees().fit(np.vstack(xs), np.concatenate(ys))


def decode(page: Page, logp: np.ndarray) -> list[int]:
    """Content blocks under the most probable labelling without contradictions."""
    n_el, n = len(page.tag), len(page.lines)
    parent, children = tree_of(page)
    score = logp.copy()
    score[n_el:, MIXED] = -1e9  # a block is one or the other
    rows = score.tolist()
    # a child's number is above its parent's, so one pass upwards sums and one downwards decides
    for e in range(n_el - 1, -1, -1):
        c0, f0, m0 = rows[e]
        for k in children[e]:
            r = rows[k]
            c0 += r[CONTENT]
            f0 += r[FURNITURE]
            m0 += max(r)
        rows[e] = [c0, f0, m0]
    choice = [MIXED] * (n_el + n)
    out = []
    for e in range(n_el + n):
        above = choice[parent[e]] if parent[e] >= 0 else MIXED
        r = rows[e]
        choice[e] = r.index(max(r)) if above == MIXED else above
        if e >= n_el and choice[e] == CONTENT:
            out.append(e - n_el)
    return out


def content_blocks(page: Page, model: Trees) -> list[int]:
    if not page.lines:
        return []
    return decode(page, model.log_probabilities(features(page, headline(page))))


def code_block(page: Page, i: int) -> bool:
    e = page.node[i]
    while e > 0:
        if page.tag[e] == "pre":
            return True
        e = page.parent[e]
    return False


def screened(page: Page) -> bool:
    """Whether any visible line shows a markup of any kind; others hold no case."""
    return bool(kinds_in(page.lines))


def page_kinds(page: Page, model: Trees) -> list[str]:
    blocks = content_blocks(page, model)
    return kinds_in([page.lines[i] for i in blocks if not code_block(page, i)])


# ------------------------------------------------------------------------ clean text

_SECTION = re.compile(r"^\\(sub)*section\*?\{(.*)\}\s*$")
_WIKI_HEAD = re.compile(r"^(={2,6})\s*(.*?)\s*={2,6}\s*$")
_MD_HEAD = re.compile(r"^(#{1,6})\s+(.*?)\s*#*$")


def clean_line(line: str, kinds: frozenset[str] | set[str]) -> str | None:
    """One line without markup; ``None`` where nothing but markup is left.

    Headings become ``#`` lines, list items ``-`` lines, table rows cells joined
    by `` | ``; formulas and code spans keep their text.
    """
    s = line
    if "html" in kinds:
        cells = re.findall(r"<t[dh]\b[^>]*>(.*?)(?=</t[dh]>|<t[dh]\b|</tr>|$)", s, re.I)
        if cells:
            s = " | ".join(cells)
        m = re.match(r"\s*<h([1-6])\b[^>]*>(.*?)(?:</h\1>)?\s*$", s, re.I)
        if m:
            s = "#" * int(m.group(1)) + " " + m.group(2)
        s = re.sub(r"^\s*<li\b[^>]*>", "- ", s, flags=re.I)
        s = re.sub(r"<br\s*/?>", " " if not re.search(r"[㐀-鿿]<br", s) else "", s, flags=re.I)
        s = re.sub(r"</?[a-zA-Z][^<>]*>|<!--.*?-->", "", s)
        s = unescape(s)
    if "latex" in kinds:
        m = _SECTION.match(s)
        if m:
            s = "#" * (2 + s.count("sub", 0, 12)) + " " + m.group(2)
        elif re.match(r"^\\(?:begin|end)\{[^}]*\}(?:\{[^}]*\})?\s*$", s):
            return None
        else:
            s = re.sub(r"^\\item\s*", "- ", s)
            if re.search(r"\\\\\s*$", s) or " & " in s and "\\" in s:
                s = re.sub(r"\\\\\s*$", "", s)
                s = " | ".join(x.strip() for x in s.split(" & "))
            s = re.sub(r"~?\\(?:cite[pt]?|label|ref)\{[^}]*\}", "", s)
            for _ in range(3):
                s = re.sub(r"\\(?:textbf|textit|texttt|emph|underline|mathrm|mathbf)\{([^{}]*)\}", r"\1", s)
    if "wiki" in kinds:
        m = _WIKI_HEAD.match(s)
        if m:
            s = "#" * len(m.group(1)) + " " + m.group(2)
        elif re.match(r"^(?:\{\|.*|\|-+|\|\})\s*$", s):
            return None
        else:
            s = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]", r"\1", s)
            s = re.sub(r"\{\{[^{}|]*\|(?:[^{}|=]*=)?([^{}]*)\}\}", r"\1", s)
            s = re.sub(r"'{2,5}", "", s)
            if re.match(r"^[|!]", s) and ("||" in s or "!!" in s):
                s = " | ".join(x.strip() for x in re.split(r"\|\||!!", s[1:]))
            s = re.sub(r"^[*#]+\s+", "- ", s)
            s = re.sub(r"</?(?:ref|nowiki)\b[^<>]*>", "", s)
    if "markdown" in kinds:
        if re.match(r"^\|?(?:\s*:?-{3,}:?\s*\|?)+$", s):
            return None
        m = _MD_HEAD.match(s)
        if m and len(m.group(1)) > 1:
            s = m.group(1) + " " + m.group(2)
        elif not re.match(r"^\s*(?:```|~~~)", s):
            if re.match(r"^\|.*\|$", s):
                s = " | ".join(x.strip() for x in s.strip("|").split("|"))
            s = re.sub(r"!\[([^\]]*)\]\([^()]*\)", r"\1", s)
            s = re.sub(r"\[([^\[\]]*)\]\([^()]*\)", r"\1", s)
            s = re.sub(r"(\*{1,3}|_{2,3})(?=\S)(.+?)(?<=\S)\1", r"\2", s)
            s = re.sub(r"`([^`]*)`", r"\1", s)
            s = re.sub(r"^[*+-]\s+", "- ", s)
            s = re.sub(r"^>\s?", "", s)
    s = " ".join(s.split())
    return s or None


def clean_text(lines: list[str], kinds: list[str]) -> str:
    """Lines of a page without markup; fenced code stays as it is."""
    have = frozenset(kinds)
    out: list[str] = []
    fenced = False
    for s in lines:
        if "markdown" in have and re.match(r"^\s*(?:```|~~~)", s):
            fenced = not fenced
            out.append("```")
            continue
        c = s if fenced else clean_line(s, have)
        if c is not None:
            out.append(c)
    return "\n".join(out)
