"""SQL counterparts of the page and document queries that SQL can express."""

from __future__ import annotations

from html import unescape
from html.entities import name2codepoint

from ..plans.skew import _SITE
from .html import INLINE

_DROP = "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|$)" for t in ("script", "style", "template", "svg"))
_BLANK = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
#: What the numbers 128 to 159 stand for.
_HIGH = "[" + ", ".join(str(ord(unescape(f"&#{c};"))) for c in range(128, 160)) + "]"


def _decoded(text: str) -> str:
    """Entities decoded once: by number, by the names of Latin-1 letters and general punctuation, the ampersand last."""
    names = {name: c for name, c in name2codepoint.items() if (c < 256 or 0x2000 <= c < 0x2100) and name != "amp"}
    number = "regexp_extract(x, '^(\\d{1,7});', 1)"
    code = f"CASE WHEN TRY_CAST({number} AS INT) BETWEEN 128 AND 159 THEN {_HIGH}[{number}::INT - 127] ELSE {number}::INT END"
    out = f"array_to_string(list_transform(string_split({text}, '&#'), lambda x, i: CASE WHEN i = 1 THEN x WHEN {number} <> '' THEN chr({code}) || substr(x, length({number}) + 2) ELSE '&#' || x END), '')"
    for name, c in names.items():
        out = f"replace({out}, '&{name};', chr({c}))"
    return f"replace(replace({out}, '&#x27;', chr(39)), '&amp;', '&')"


def _normal(line: str) -> str:
    return f"regexp_replace(lower({line}), '[0-9]+', '0', 'g')"


#: ``lines`` of every page as ``host, id, lines``; ``frequent`` lines in normal form as ``host, line``.
LINES = rf"""p AS (SELECT DISTINCT {_SITE} AS host, id, decode(html) AS h FROM pages WHERE html IS NOT NULL),
    clean AS (SELECT host, id, regexp_replace(h, '(?is)<!--.*?(?:-->|$)|{_DROP}', '', 'g') AS h FROM p),
    body AS (SELECT host, id, regexp_replace(CASE WHEN regexp_matches(h, '(?i)<body\b[^>]*>') THEN regexp_extract(h, '(?is)<body\b[^>]*>(.*)', 1) ELSE h END, '(?is)</body\s*>.*', '') AS h FROM clean),
    cut AS (SELECT host, id, regexp_replace(regexp_replace(h, '(?i)</?(?:{"|".join(sorted(INLINE))})(?:[\s/][^>]*)?>', '', 'g'), '<(?:/?[a-zA-Z]|[!?])[^>]*>', chr(1), 'g') AS s FROM body),
    plain AS (SELECT host, id, {_decoded("s")} AS s FROM cut),
    page AS (SELECT host, id, list_filter(list_transform(string_split(s, chr(1)), lambda x: trim(regexp_replace(x, '{_BLANK}', ' ', 'g'))), lambda x: x <> '') AS lines FROM plain),
    line AS (SELECT DISTINCT host, id, unnest(list_transform(lines, lambda x: {_normal("x")})) AS line FROM page),
    total AS (SELECT host, count(DISTINCT id) AS n_host FROM p GROUP BY host),
    frequent AS (SELECT host, line FROM (SELECT host, line, count(*) AS n FROM line GROUP BY 1, 2) JOIN total USING (host) WHERE n >= 5 AND 4 * n >= n_host)"""

SQL = {
    "p7_found": f"WITH {LINES} SELECT host, line FROM frequent",
    "p7_clean": f"""WITH {LINES}, own AS (SELECT host, list(line) AS gone FROM frequent GROUP BY host),
        kept AS (SELECT host, id, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(gone, []), {_normal("x")})) AS rest FROM page LEFT JOIN own USING (host))
        SELECT host, id, array_to_string(rest, chr(10)) AS text, CAST(len(lines) - len(rest) AS INT) AS n_removed FROM kept""",
}
