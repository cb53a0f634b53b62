"""Finding and restoring text that was decoded with a wrong character set.

Method: best-first graph search. A state is a text; edges re-encode it with a
charset it may have been *decoded* with and decode the bytes with the charset
it was *written* in, or unescape entities once more. States are visited once
(hash of the text), the frontier is ordered by an implausibility cost of the
characters plus a small price per step, and the cheapest reachable text wins.
The first steps may lead through dearer texts; from :data:`FREE_STEPS` on a step
must make its text cheaper, so text encoded any number of times is undone.

A cheap screen keeps clean lines out of the search: only lines with characters
or letter pairs that mojibake leaves behind become start states.

Defined results: ``None`` and empty text are clean; text whose characters were
lost (U+FFFD, question marks inside words) counts as garbled and not
restorable where no state without the loss is reachable; ties between equally
cheap texts go to the one found with fewer steps.
"""

from __future__ import annotations

import codecs
import heapq
import re
import unicodedata
from collections import Counter
from html import unescape

_VN = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
_VN_SET = frozenset(_VN + _VN.upper())
_TYPO = frozenset("©»«°±µ·×–—‘’“”…−≈√≤≥→×÷、。,!?:;()《》【】「」·~%¥")


def _weight(ch: str) -> float:
    """Implausibility of one character in a text of this corpus' languages."""
    o = ord(ch)
    if o < 128:
        return 0.0 if ch.isalnum() or ch.isspace() else (0.05 if o >= 32 else 4.0)
    if ch in _VN_SET:
        return 0.1
    if ch in _TYPO:
        return 0.25
    if o < 0xA0 or ch == "�" or 0xE000 <= o <= 0xF8FF or o >= 0x20000:
        return 4.0
    if 0x4E00 <= o <= 0x9FFF:
        try:
            lead = ch.encode("gb2312")[0]
        except UnicodeEncodeError:
            return 1.6
        return 0.15 if lead < 0xD8 else 0.7
    if o == 0xA0 or o == 0x3000:
        return 0.2
    if o < 0x100:
        return 1.0 if ch.isalpha() else 1.5
    if 0x300 <= o <= 0x36F:
        return 0.6
    if o < 0x250 or 0x1E00 <= o < 0x1F00:
        return 1.2
    if 0x2000 <= o < 0x2100 or 0x20A0 <= o < 0x2200:
        return 1.2
    if 0xFF00 <= o < 0xFF60 or 0x2200 <= o < 0x2300 or 0x370 <= o < 0x400:
        return 0.8
    return 1.8


class _Weights(dict):
    def __missing__(self, ch: str) -> float:
        w = self[ch] = _weight(ch)
        return w


_W = _Weights()
_ACC = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụừứửữựỳýỷỹỵ"
_ODD_PAIR = re.compile(
    f"[a-zđ{_ACC}ư][{_VN.upper()}ÌÒÞÝÕÃÐÂ](?![A-Z{_VN.upper()}])"  # capital inside a word
    f"|[{_ACC}][{_ACC}]"  # two marked vowels, other than after ư
    "|[A-Za-z][一-鿿][a-z]"  # an ideograph inside a Latin word
)
_LOST = re.compile(f"[^\\W\\d_]\\?[^\\W\\d_A-Z]|(?:^|(?<=[\\s(\"“]))\\?+[^\\W\\d_A-Z]|[^\\W\\d_]\\?\\?+(?=[^\\W\\d_]|\\s)|\\?{{4,}}|\\?\\s\\?\\s\\?", re.M)


def cost(text: str) -> float:
    """Total implausibility of a text; 0 for plain ASCII words."""
    c = sum(map(_W.__getitem__, text))
    if not text.isascii():
        c += 1.5 * len(_ODD_PAIR.findall(text))
    if "?" in text:
        c += 2.0 * len(_LOST.findall(text))
    return c


# Characters a lenient single-byte reader shows for bytes 80-9F, fixed by the public code page tables.
_SLOPPY = {ord(bytes([b]).decode("cp1252")): b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
_CP1258_ONLY = re.compile("[̣̀́̃̉]")


def _as_bytes(text: str, charset: str) -> bytes:
    if charset == "cp1252":
        return text.translate(_SLOPPY).encode("latin-1")
    return text.encode(charset)


#: (charset the bytes were read with, charset they were written in)
STEPS = (
    ("cp1252", "utf-8"), ("gb18030", "utf-8"), ("cp1252", "gb18030"), ("cp1252", "cp1258"), ("cp1258", "utf-8"),
    ("cp1251", "utf-8"), ("big5hkscs", "utf-8"), ("mac_roman", "utf-8"), ("cp437", "utf-8"), ("shift_jis", "utf-8"), ("cp1252", "big5"),
)
#: Parts of a line that a single-byte reader could have shown; the rest stays as it is.
_PART = {
    "cp1252": re.compile("[\x00-\xff" + "".join(map(chr, _SLOPPY)) + "]+"),
    "gb18030": re.compile("[^�]+"),
}
_UTF8_LEADS = re.compile(rb"[\xc2-\xf4][\x80-\xbf]")


def _keep(error: UnicodeError) -> tuple[str, int]:
    """Bytes that are no part of a garbled sequence stay the characters they were shown as."""
    bad = error.object[error.start : error.end]
    return "".join(_SHOWN[b] for b in bad), error.end


_SHOWN = [chr(b) for b in range(256)]
for _char, _byte in _SLOPPY.items():
    _SHOWN[_byte] = chr(_char)
codecs.register_error("millrace_keep", _keep)


def apply_step(text: str, read: str, written: str) -> str | None:
    """The text under one repair step, ``None`` where the step is impossible.

    First the whole text, strictly; else each maximal part the reader could
    have shown, decoding what can be decoded.
    """
    try:
        out = _as_bytes(text, read).decode(written)
    except UnicodeError:
        part = _PART.get(read)
        if part is None:
            return None
        changed = False

        def one(m: re.Match[str]) -> str:
            nonlocal changed
            s = m.group(0)
            if s.isascii():
                return s
            try:
                b = _as_bytes(s, read)
            except UnicodeError:
                return s
            if written == "utf-8" and not _UTF8_LEADS.search(b):
                return s
            try:
                r = b.decode(written)
            except UnicodeError:
                r = b.decode(written, "millrace_keep" if read == "cp1252" else "replace")
                if r.count("\ufffd") * 3 > len(r):
                    return s
            changed = True
            return r

        out = part.sub(one, text)
        if not changed:
            return None
    if written == "cp1258" and _CP1258_ONLY.search(out):
        out = unicodedata.normalize("NFC", out)
    return None if out == text else out


STEP_PRICE = 0.4
#: Steps that may lead to any text; a later one must lead to a cheaper one.
FREE_STEPS = 4
#: Cost per character at which a state counts as clean and ends the search.
GOAL = 0.17


def restore(text: str, first: tuple = ()) -> tuple[str, tuple, float, float]:
    """Cheapest text reachable: (text, steps, its cost, cost before).

    ``first`` is a path to try at once, e.g. the one that restored the line
    before; the search runs only where it does not give a clean text.
    """
    start = cost(text)
    if first:
        s: str | None = text
        for step in first:
            s = unescape(s) if step == "unescape" else apply_step(s, *step)
            if s is None:
                break
        if s is not None:
            c = cost(s)
            if c <= 0.25 * start and "�" not in s:
                return s, first, c, start
    best = (start, 0, text, ())
    frontier: list[tuple[float, int, str, tuple]] = [(start, 0, text, ())]
    seen = {hash(text)}
    while frontier:
        priority, depth, s, path = heapq.heappop(frontier)
        if depth and priority > start:
            break
        above = cost(s) if depth >= FREE_STEPS else None
        nexts = [(step, apply_step(s, *step)) for step in STEPS] if not s.isascii() else []
        if "&" in s and ";" in s:
            nexts.append(("unescape", unescape(s)))
        for step, out in nexts:
            if out is None or out == s:
                continue
            h = hash(out)
            if h in seen:
                continue
            seen.add(h)
            c = cost(out)
            if above is not None and c >= above:
                continue
            p = c + STEP_PRICE * (depth + 1)
            entry = (p, depth + 1, out, (*path, step))
            heapq.heappush(frontier, entry)
            if p < best[0]:
                best = entry
                if c <= GOAL * len(out) and c <= 0.25 * start:  # as plausible as clean text gets
                    return out, entry[3], c, start
    c = cost(best[2])
    return best[2], best[3], c, start


def _gbk_only() -> str:
    """Character class of ideographs outside the national standard's common set, as ranges."""
    out, lo = [], None
    for o in range(0x4E00, 0xA001):
        rare = False
        if o <= 0x9FFF:
            try:
                chr(o).encode("gb2312")
            except UnicodeEncodeError:
                rare = True
        if rare and lo is None:
            lo = o
        elif not rare and lo is not None:
            out.append(f"{chr(lo)}-{chr(o - 1)}" if o - 1 > lo else chr(lo))
            lo = None
    return "".join(out)


#: Characters that mojibake leaves behind; one is enough to look closer.
_MARKS = (
    "\x80-\x9f\ufffd\ue000-\uf8ff\u00a1-\u00a8\u00aa\u00ac-\u00af\u00b2-\u00b4\u00b6\u00b8-\u00ba\u00bc-\u00bf"
    "ÄÅÆÇÐÞßåæçðþŒœŠšŸŽžƒˆ˜†‡‰‹›€™„‚•ぁ-ㄯ"
)
_PAIRS = "(?<=[a-zêôâãõý])[ÌÒÞÕÝÃ]|(?<=[êôâãõýÞÝÕ])[ìò]|(?<=[A-Za-z])[一-鿿]{1,2}[a-z]"
_QUESTIONS = "[^\\W\\d_]\\?[^\\W\\d_A-Z]|\\s\\?[^\\W\\d_A-Z]|\\?\\?|\\? \\?"
_MARK = f"[{_MARKS}{_gbk_only()}]"
SCREEN = re.compile(f"{_MARK}|{_PAIRS}|{_QUESTIONS}")
_PAIR_SCREEN = re.compile("[ÌÒÞÕÝÃìò](?:(?<=[a-zêôâãõý][ÌÒÞÕÝÃ])|(?<=[êôâãõýÞÝÕ][ìò]))")
_MIXED_SCREEN = re.compile("[一-鿿]{1,2}[a-z](?:(?<=[A-Za-z][一-鿿].)|(?<=[A-Za-z][一-鿿]{2}.))")
_QUESTION_SCREEN = re.compile(_QUESTIONS)
_MARK_SCREEN = re.compile(_MARK)


def suspicious(text: str) -> bool:
    """The screen for a whole page: the same marks as :data:`SCREEN`, faster on clean text."""
    if text.isascii():
        return "?" in text and bool(_QUESTION_SCREEN.search(text))
    return (
        bool(_MARK_SCREEN.search(text))
        or bool(_PAIR_SCREEN.search(text))
        or bool(_MIXED_SCREEN.search(text))
        or "?" in text
        and bool(_QUESTION_SCREEN.search(text))
    )


_HARD_LOSS = re.compile("[\ufffd\x80-\x9f\ue000-\uf8ff]")
#: An address may hold question marks inside words.
_ADDRESS = re.compile(r"\S*(?:://|www\.|=)\S*")


#: Fall of the cost, over a page's repaired lines, from which they count as garbled.
MIN_GAIN = 1.25


def _share_left(line: str, text: str) -> float:
    """Cost left over of the characters that a repair changed; the rest of the line does not count."""
    was, now = Counter(line), Counter(text)
    gone = sum(_W[c] * n for c, n in (was - now).items())
    come = sum(_W[c] * n for c, n in (now - was).items())
    return come / gone if gone > 0 else 1.0


def judge(line: str, first: tuple = ()) -> tuple[float, str, tuple, int]:
    """(fall of the cost by a believable repair, restored text, steps, word-internal losses) of a screened line."""
    text, path, after, before = restore(line, first)
    lost = len(_LOST.findall(_ADDRESS.sub(" ", line))) if "?" in line else 0
    if path and before > after and (after <= 0.6 * before or _share_left(line, text) <= 0.6):
        return before - after, text, path, lost
    return 0.0, line, (), lost


#: Question marks inside words that count as lost characters without further evidence.
MIN_LOST = 3
_VOWELS = "aeiouy" + "".join(c for c in _VN if c != "đ")
_TORN = re.compile(r"(?<![\w?&/.])([^\W\d_]+)\?([^\W\d_]+)(?![\w?=/])")
_TORN_END = re.compile(rf"(?<![\w?&/.])([^\W\d_{_VOWELS}A-Z]{{1,4}})\?(?=\s+[^\W\d_A-Z])")
#: Short forms and units that end a real question.
_SHORT = frozenset("mg ml kg g m cm mm km l dl mmhg thx pls plz pm tks thks sđt bs ks vs dr mr sth sb ng đ k b ko h t c".split())


def surely_lost(text: str) -> bool:
    """Whether a single question mark is a lost letter beyond doubt: no word is left on one of its sides, or the page
    shows the word with one letter in its place."""
    text = _ADDRESS.sub(" ", text)
    for m in _TORN_END.finditer(text):
        if m.group(1) not in _SHORT and "一" > m.group(1):
            return True
    words = None
    for m in _TORN.finditer(text):
        left, right = m.group(1), m.group(2)
        if max(left) >= "⺀" or max(right) >= "⺀" or right[0].isupper():
            continue  # ideographs are not divided into words; a capital begins a sentence
        bare = [x for x in (left, right) if len(x) <= 3 and x.islower() and not any(c in _VOWELS for c in x)]
        if len(bare) == 2 or any(x not in _SHORT for x in bare):
            return True
        if words is None:
            words = set(re.findall(r"[^\W\d_]+", text.lower()))
        whole = re.compile(f"{left.lower()}[^\\W\\d_]{right.lower()}")
        if any(map(whole.fullmatch, words)):
            return True
    return False


def garbled(raw_lines: list[str], all_lines: bool = False) -> tuple[bool, list[tuple[int, str]]]:
    """Whether any line of a page is garbled; with ``all_lines`` also the
    restored text by line number (only lines that change)."""
    found = False
    lost = 0
    gain = 0.0
    path: tuple = ()
    text = "\n".join(raw_lines)
    if "&" in text:
        text = unescape(text)
    if not suspicious(text) and not ("?" in text and _TORN_END.search(text)):
        return False, []
    if "?" in text and surely_lost(text):
        found = True
        if not all_lines:
            return True, []
    changed: list[tuple[int, str]] = []
    for i, raw in enumerate(raw_lines):
        line = unescape(raw) if "&" in raw else raw
        if line.isascii() and "?" not in line or not SCREEN.search(line):
            continue
        fall, text, steps, n = judge(line, path)
        lost += n
        gain += fall
        if steps:
            path = steps
            changed.append((i, text))
        elif _HARD_LOSS.search(line):
            found = True
        if not all_lines and (found or gain >= MIN_GAIN):
            return True, []
    if gain < MIN_GAIN:
        changed = []
    return found or bool(changed) or lost >= MIN_LOST, changed
