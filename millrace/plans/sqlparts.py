"""SQL fragments shared by the SQL counterparts."""

RX = r"'^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?'"


def netloc(u: str) -> str:
    return f"regexp_extract(ltrim({u}), {RX}, 1)"


def host_key(u: str) -> str:
    return f"lower({netloc(u)})"


def hostname(u: str) -> str:
    return f"lower(regexp_replace(regexp_replace({netloc(u)}, '^.*@', ''), ':[0-9]*$', ''))"


def site(u: str) -> str:
    return f"regexp_replace({hostname(u)}, '^www\\.', '')"


def path(u: str) -> str:
    return f"regexp_replace(regexp_extract(ltrim({u}), {RX}, 2), ';[^/]*$', '')"


def query(u: str) -> str:
    return f"regexp_extract(ltrim({u}), {RX}, 3)"


def canonical(u: str) -> str:
    t = f"regexp_replace({u}, '^\\s+|\\s+$', '', 'g')"
    return f"({site(t)} || regexp_replace({path(t)}, '/+$', '') || CASE WHEN {query(t)} <> '' THEN '?' || {query(t)} ELSE '' END)"


def article_path(u: str) -> str:
    return f"lower(regexp_replace(trim(url_decode({path(u)})), '/+$', ''))"


def last(p: str) -> str:
    return f"list_extract(string_split({p}, '/'), -1)"


def tokens(p: str) -> str:
    s = f"regexp_replace({last(p)}, '\\.\\w{{2,5}}$', '')"
    return f"list_distinct(list_filter(regexp_split_to_array({s}, '[-_\\s.]+'), lambda t: t <> '' AND NOT regexp_full_match(t, '\\d+')))"


EXT = r"'(?i)\.(jpe?g|png|gif|webp|bmp|svg|pdf|docx?|xlsx?|zip|mp4|mp3)$'"


def is_home(o: str, f: str) -> str:
    return f"({path(f)} IN ('', '/') AND {query(f)} = '' AND {path(o)} NOT IN ('', '/'))"


def redirect_kind(u: str, f: str) -> str:
    pu, pf = article_path(u), article_path(f)
    tu, tf = tokens(pu), tokens(pf)
    return f"""CASE WHEN {site(u)} = {site(f)} AND {pu} = {pf} THEN NULL
        WHEN regexp_matches({pf}, {EXT}) THEN 'non_html'
        WHEN len(list_filter(regexp_extract_all({last(pu)}, '\\d{{5,}}'), lambda n: contains({last(pf)}, n))) > 0 THEN 'same_article'
        WHEN len({tu}) > 0 AND len(list_intersect({tu}, {tf})) / len(list_distinct(list_concat({tu}, {tf}))) >= 0.6 THEN 'same_article'
        ELSE 'different_article' END"""


def unwrapped(f: str) -> str:
    inner = f"regexp_extract({f}, '/web/\\d+id_/(.+)$', 1)"
    return f"(CASE WHEN {inner} <> '' THEN {inner} WHEN contains({f}, 'id_/') THEN substr({f}, instr({f}, 'id_/') + 4) ELSE {f} END)"


def surt(h: str) -> str:
    return f"(array_to_string(list_reverse(string_split(regexp_replace({h}, '^www\\.', ''), '.')), ',') || ')/')"


def segment(u: str) -> str:
    p = path(u)
    return f"(CASE WHEN length({p}) - length(replace({p}, '/', '')) > 1 THEN split_part({p}, '/', 2) ELSE '' END)"
