"""URL functions as Column expressions: parsing, canonical keys, host groups.

All stay JVM-side. URLs are split by the generic-syntax regular expression of
RFC 3986 appendix B, not by ``parse_url``, which returns NULL for addresses with
blanks, bars or bad percent escapes that crawls are full of.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: scheme, authority, path, query of RFC 3986 appendix B.
URL_RX = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def _c(url: Column | str) -> Column:
    return F.col(url) if isinstance(url, str) else url


def trimmed(url: Column | str) -> Column:
    """Without white space around it, Unicode white space included."""
    return F.regexp_replace(_c(url), r"(?U)^\s+|\s+$", "")


def netloc(url: Column | str) -> Column:
    """Authority part as written: user, host and port."""
    return F.regexp_extract(F.ltrim(_c(url)), URL_RX, 1)


def host_key(url: Column | str) -> Column:
    """Lower-case authority: keeps port, user part and ``www.``."""
    return F.lower(netloc(url))


def hostname(url: Column | str) -> Column:
    """Lower-case host name without user part and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(netloc(url), r"^.*@", ""), r":[0-9]*$", ""))


def site(url: Column | str) -> Column:
    """Host name without user part, port and one leading ``www.``."""
    return F.regexp_replace(hostname(url), r"^www\.", "")


def url_path(url: Column | str) -> Column:
    """Path without the parameters of its last segment."""
    return F.regexp_replace(F.regexp_extract(F.ltrim(_c(url)), URL_RX, 2), r";[^/]*$", "")


def url_query(url: Column | str) -> Column:
    return F.regexp_extract(F.ltrim(_c(url)), URL_RX, 3)


#: Registries under which sites register at the third level, fixed values.
MULTI_PART_SUFFIXES = ("com.cn", "com.vn", "org.vn", "gov.vn", "edu.vn", "net.vn", "org.cn", "gov.cn")
NON_HTML_EXT = r"(?i)\.(jpe?g|png|gif|webp|bmp|svg|pdf|docx?|xlsx?|zip|mp4|mp3)$"


def site_group(host: Column | str, known: tuple[str, ...] = ()) -> Column:
    """Hosts that share one rate limit: a known group itself, else the last two
    labels, three below a multi-part suffix."""
    h = _c(host)
    labels = F.split(h, r"\.")
    last = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), F.lit(n)), ".")
    grouped = F.when(last(2).isin(*MULTI_PART_SUFFIXES), last(3)).otherwise(last(2))
    return F.when(h.isin(*known), h).otherwise(grouped) if known else grouped


def canonical(url: Column | str) -> Column:
    """Key under which variants of one address meet: host without ``www.``, path
    without trailing slashes and in its own case, query; no scheme, port, user,
    parameters or fragment."""
    u = trimmed(url)
    path = F.regexp_replace(url_path(u), "/+$", "")
    query = url_query(u)
    return F.concat(site(u), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def surt(host: Column | str, path: Column | str | None = None) -> Column:
    """Sort-friendly key: reversed host labels, ``)/``, path."""
    h = F.regexp_replace(_c(host), r"^www\.", "")
    key = F.concat(F.array_join(F.reverse(F.split(h, r"\.")), ","), F.lit(")/"))
    return F.concat(key, _c(path)) if path is not None else key


def capture_key(url: Column | str, pattern: str, prefix: str) -> Column:
    """``prefix:<number>`` where the pattern finds an article number, else the canonical key."""
    number = F.regexp_extract(_c(url), pattern, 1)
    return F.when(number != "", F.concat(F.lit(prefix + ":"), number)).otherwise(canonical(url))


def percent_decoded(text: Column) -> Column:
    """Percent decoding that keeps ``+`` and malformed escapes."""
    safe = F.regexp_replace(F.regexp_replace(text, r"\+", "%2B"), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), text)


def article_path(url: Column | str) -> Column:
    """Decoded path in lower case without blanks at its ends and trailing slashes; query ignored."""
    p = F.regexp_replace(percent_decoded(url_path(url)), " ", " ")
    return F.lower(F.regexp_replace(F.regexp_replace(p, r"(?U)^\s+|\s+$", ""), "/+$", ""))


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def slug_tokens(path: Column) -> Column:
    """Distinct words of the last segment without extension; numbers left out."""
    last = F.regexp_replace(last_segment(path), r"\.\w{2,5}$", "")
    return F.array_distinct(F.filter(F.split(last, r"[-_\s.]+"), lambda t: (t != "") & ~t.rlike(r"^\d+$")))


def is_home(origin: Column | str, final: Column | str) -> Column:
    """The address ended on a site's root though it did not start there."""
    return url_path(final).isin("", "/") & (url_query(final) == "") & ~url_path(origin).isin("", "/")


def redirect_kind(url: Column | str, final: Column | str) -> Column:
    """NULL for the same address, else ``non_html``, ``same_article`` or ``different_article``."""
    pu, pf = article_path(url), article_path(final)
    numbers = F.regexp_extract_all(last_segment(pu), F.lit(r"(\d{5,})"), F.lit(1))
    kept = F.exists(numbers, lambda n: F.contains(last_segment(pf), n))
    tu, tf = slug_tokens(pu), slug_tokens(pf)
    alike = (F.size(tu) > 0) & (F.size(F.array_intersect(tu, tf)) / F.size(F.array_union(tu, tf)) >= 0.6)
    return (
        F.when((site(url) == site(final)) & (pu == pf), F.lit(None).cast("string"))
        .when(pf.rlike(NON_HTML_EXT), "non_html")
        .when(kept | alike, "same_article")
        .otherwise("different_article")
    )


def unwrapped(final: Column | str) -> Column:
    """Captured address inside an archive's replay address: behind its time stamp, else behind the first ``id_/``, else the address."""
    url = _c(final)
    inner = F.regexp_extract(url, r"/web/\d+id_/(.+)$", 1)
    at = F.instr(url, "id_/")
    return F.when(inner != "", inner).when(at > 0, F.substr(url, at + 4)).otherwise(url)


def first_segment(url: Column | str) -> Column:
    """First path segment, blank where the path has only one."""
    p = url_path(url)
    return F.when(F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit(""))) > 1, F.split_part(p, F.lit("/"), F.lit(2))).otherwise(F.lit(""))


def flat_address(url: Column | str, new_host: str) -> Column:
    """The same page on another host as ``/<path>.htm``."""
    return F.concat(F.lit(f"https://{new_host}/"), F.regexp_replace(url_path(url), "^/+|/+$", ""), F.lit(".htm"))


def page_number(url: Column | str) -> Column:
    """Last run of five or more digits of the path, NULL without one."""
    all_ = F.regexp_extract_all(url_path(url), F.lit(r"(\d{5,})"), F.lit(1))
    return F.when(F.size(all_) > 0, F.element_at(all_, -1).cast("long"))
