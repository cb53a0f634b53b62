"""Rule-based classification of fetched pages, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .urls import NON_HTML_EXT, is_home, url_path

# Phrases of interstitial pages and first bytes of file formats.
SLIDER = "滑动拼图验证"
MAGIC = (b"\xff\xd8\xff", b"\x89PNG", b"GIF8", b"%PDF", b"RIFF", b"PK\x03\x04")

KINDS = ("ok", "notfound", "home", "robots", "http4xx", "nonhtml", "error", "blocked", "captcha", "unmapped")


def body_text(body: Column, n: int) -> Column:
    """First n bytes as text, a character for each byte."""
    return F.decode(F.substring(body, 1, n), "ISO-8859-1")


def has_magic(body: Column) -> Column:
    """Starts, after white space within the first 16 bytes, with a file format's magic number."""
    head = F.encode(F.regexp_replace(F.decode(F.substring(body, 1, 16), "ISO-8859-1"), r"^[\s\x0B]+", ""), "ISO-8859-1")
    hit = F.lit(False)
    for m in MAGIC:
        hit = hit | F.startswith(head, F.lit(m))
    return hit


def is_non_html(final_url: Column, ctype: Column, body: Column) -> Column:
    t = F.lower(F.coalesce(ctype, F.lit("")))
    foreign = (t != "") & ~(t.contains("html") | t.contains("xml") | t.contains("text/plain"))
    return foreign | url_path(final_url).rlike(NON_HTML_EXT) | F.coalesce(has_magic(body), F.lit(False))


def fetch_kind(status: Column, final_url: Column, body: Column, ctype: Column, mitigated: Column | None = None, slider: bool = True) -> Column:
    """Outcome of a fetch; the order of the tests is the contract."""
    b = F.coalesce(body, F.lit("").cast("binary"))
    low = F.lower(body_text(b, 4000))
    final = F.coalesce(final_url, F.lit(""))
    captcha = final.contains("verify.html") | F.lower(final).contains("captcha")
    if slider:
        captcha = captcha | F.contains(F.substring(b, 1, 6000), F.lit(SLIDER.encode()))
    blocked = low.contains("just a moment...") | low.contains("attention required! | cloudflare")
    if mitigated is not None:
        blocked = blocked | (F.coalesce(mitigated, F.lit("")) != "")
    challenge = (F.length(b) < 2000) & low.contains("document.cookie") & low.contains("location.reload")
    return (
        F.when(captcha, "captcha")
        .when(blocked | challenge, "blocked")
        .when(status.isin(403, 429), "blocked")
        .when(status.isin(404, 410), "notfound")
        .when(status >= 500, "error")
        .when(status >= 400, "http4xx")
        .when(is_non_html(final, ctype, b), "nonhtml")
        .otherwise("ok")
    )


def with_home(kind: Column, origin: Column, final: Column) -> Column:
    """An ``ok`` page that ended on the site's root is ``home``."""
    return F.when((kind == "ok") & is_home(origin, final), "home").otherwise(kind)


def strip_markup(body: Column) -> Column:
    """Body without style, svg and comments; scripts stay."""
    return F.regexp_replace(body, r"(?is)<style\b.*?</style>|<svg\b.*?</svg>|<!--.*?-->", "")


def page_title(body: Column, n: int = 60) -> Column:
    title = F.regexp_extract(body, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.substring(F.regexp_replace(title, r"(?U)^\s+|\s+$", ""), 1, n)
