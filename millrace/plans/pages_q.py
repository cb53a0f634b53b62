"""Queries over stored pages: classification, the store, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import urls as U
from ..operators import store as S
from ..session import table
from . import sqlparts as Q


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages")


# Fetch results derived from page ids, so that every outcome occurs.
def derived_final() -> Column:
    i = F.col("id")
    return (
        F.when(i % 23 == 5, F.concat(F.lit("https://"), U.hostname("url"), F.lit("/verify.html")))
        .when(i % 19 == 7, F.concat(F.lit("https://"), U.hostname("url"), F.lit("/img/"), i.cast("string"), F.lit(".jpg")))
        .when(i % 7 == 1, F.concat(F.lit("https://"), U.hostname("url"), F.lit("/")))
        .otherwise(F.col("url"))
    )


def _status() -> Column:
    i = F.col("id")
    return F.when(i % 17 == 3, 403).when(i % 11 == 2, 404).when(i % 13 == 4, 503).when(i % 29 == 6, 451).otherwise(200)


FINAL_SQL = f"""(CASE WHEN id % 23 = 5 THEN 'https://' || {Q.hostname('url')} || '/verify.html' WHEN id % 19 = 7 THEN 'https://' || {Q.hostname('url')} || '/img/' || id || '.jpg'
    WHEN id % 7 = 1 THEN 'https://' || {Q.hostname('url')} || '/' ELSE url END)"""
_FETCH_SQL = f"""SELECT source, id, url, html, ctype, {FINAL_SQL} AS f,
    CASE WHEN id % 17 = 3 THEN 403 WHEN id % 11 = 2 THEN 404 WHEN id % 13 = 4 THEN 503 WHEN id % 29 = 6 THEN 451 ELSE 200 END AS s
    FROM pages WHERE html IS NOT NULL"""


def classify_kind(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d).where("html is not null").withColumn("f", derived_final()).withColumn("s", _status())
    kind = C.with_home(C.fetch_kind(F.col("s"), F.col("f"), F.col("html"), F.col("ctype")), F.col("url"), F.col("f"))
    return p.select("source", "id", kind.alias("kind")).groupBy("source", "id").agg(F.min("kind").alias("kind"))


def classify_kind_plain(spark: SparkSession, d: str) -> DataFrame:
    """The variant without the slider test and the mitigation header, counted by kind."""
    p = _pages(spark, d).where("html is not null").withColumn("f", derived_final()).withColumn("s", _status())
    kind = C.fetch_kind(F.col("s"), F.col("f"), F.col("html"), F.col("ctype"), slider=False)
    return p.select(kind.alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def non_html_magic(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose address, type or first bytes say they are no page; every fifth body gets a file's first bytes."""
    fake = F.concat(F.lit(b"\n "), F.element_at(F.array(*[F.lit(m) for m in C.MAGIC]), (F.col("id") % 6 + 1).cast("int")))
    body = F.when(F.col("id") % 5 == 0, fake).otherwise(F.coalesce("html", F.lit("").cast("binary")))
    p = _pages(spark, d).select("source", "id", "kind", F.coalesce("final_url", "url").alias("f"), "ctype", body.alias("b"))
    return p.groupBy("source", "kind").agg(F.count_if(C.is_non_html(F.col("f"), F.col("ctype"), F.col("b"))).alias("n_non_html"), F.count("*").alias("n"))


def strip_html_bytes(spark: SparkSession, d: str) -> DataFrame:
    h = _pages(spark, d).where("html is not null").select("source", "id", F.col("html").cast("string").alias("h")).dropDuplicates(["source", "id"])
    s = C.strip_markup(F.col("h"))
    return h.select("source", "id", F.octet_length(s).cast("long").alias("n_bytes"), F.md5(s).alias("md5"))


def page_title(spark: SparkSession, d: str) -> DataFrame:
    h = _pages(spark, d).where("html is not null").select("source", "id", F.col("html").cast("string").alias("h")).dropDuplicates(["source", "id"])
    return h.select("source", "id", C.page_title(F.col("h")).alias("title"))


def upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    return S.latest(_pages(spark, d).drop("html")).select("source", "id", "kind", "status", "attempts", "fetched_at")


def pending_antijoin(spark: SparkSession, d: str) -> DataFrame:
    return S.pending(table(spark, d, "corpus"), _pages(spark, d).select("id", "kind", "attempts")).select("id", "attempts")


def attempts_exhausted(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d).groupBy("id").agg(F.max("attempts").alias("attempts"), F.max(F.col("kind").isin(*S.DONE_KINDS)).alias("is_done"))
    return p.where((F.col("attempts") >= S.MAX_ATTEMPTS) & ~F.col("is_done")).select("id", "attempts")


def stored_semi(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus").join(S.stored_ids(_pages(spark, d)), "id", "left_semi").select("id", "url")


def done_definitions(spark: SparkSession, d: str) -> DataFrame:
    """The six meanings of done side by side: ids by meaning."""
    p = _pages(spark, d).select("id", "source", "kind", "attempts", F.col("html").isNotNull().alias("has_body"))
    db = F.col("source") == "db"
    rules = {
        "resume": F.col("kind").isin(*S.DONE_KINDS) | (F.col("attempts") >= S.MAX_ATTEMPTS),
        "archive_guard": F.col("kind") == "ok",
        "index_have": F.col("kind").isin(*S.ARCHIVE_HAVE),
        "missing_pass": db & (F.col("kind") == "ok") & F.col("has_body"),
        "coverage_dead": db & F.col("kind").isin(*S.DEAD_KINDS),
        "progress": F.col("kind").isin("ok", "notfound", "home", "robots", "http4xx"),
    }
    flags = p.groupBy("id").agg(*[F.max(r).alias(n) for n, r in rules.items()])
    return flags.agg(*[F.count_if(F.col(n)).alias(n) for n in rules])


def corrective_update(spark: SparkSession, d: str) -> DataFrame:
    """Stored pages whose final address is a file become nonhtml and lose their body."""
    p = _pages(spark, d).where("kind = 'ok'").withColumn("f", derived_final())
    fixed = S.corrected(p, F.regexp_extract("f", U.URL_RX, 2).rlike(U.NON_HTML_EXT), "nonhtml")
    return fixed.groupBy("source", "kind").agg(F.count("*").alias("n"), F.count("html").alias("n_bodies"), F.count_if("corrected").alias("n_corrected"))


def normalised_failures(spark: SparkSession, d: str) -> DataFrame:
    p = S.normalised(_pages(spark, d).select("source", "kind", "status", "final_url"))
    return p.groupBy("source", "kind").agg(F.count("status").alias("n_status"), F.count("final_url").alias("n_final"), F.count("*").alias("n"))


def body_cap(spark: SparkSession, d: str) -> DataFrame:
    """Bodies cut at a limit, next to the size reported."""
    p = _pages(spark, d).where("html is not null").select("source", F.octet_length(F.substring("html", 1, 2000)).alias("n"), "nbytes")
    return p.groupBy("source").agg(F.sum("n").cast("long").alias("kept"), F.sum("nbytes").cast("long").alias("reported"), F.count_if(F.col("n") == 2000).alias("n_cut"))


QUERIES = {
    f.__name__: f
    for f in (
        classify_kind, classify_kind_plain, non_html_magic, strip_html_bytes, page_title, upsert_latest, pending_antijoin, attempts_exhausted, stored_semi,
        done_definitions, corrective_update, normalised_failures, body_cap,
    )
}

_MAGIC_SQL = " OR ".join(f"starts_with(hx, '{m.hex().upper()}')" for m in C.MAGIC)
_NON_HTML = f"""((ct <> '' AND NOT (contains(ct, 'html') OR contains(ct, 'xml') OR contains(ct, 'text/plain')))
    OR regexp_matches({Q.path('f')}, {Q.EXT}) OR {_MAGIC_SQL})"""


def _hex_head(b: str) -> str:
    """First 16 bytes in hex without white space bytes in front."""
    return f"regexp_replace(hex({b})[1:32], '^(?:09|0A|0B|0C|0D|20)+', '')"


def _kind(slider: bool) -> str:
    s = f" OR contains(hex(html)[1:12000], '{C.SLIDER.encode().hex().upper()}')" if slider else ""
    low = "lower(decode(html)[1:4000])"
    return f"""CASE WHEN contains(f, 'verify.html') OR contains(lower(f), 'captcha'){s} THEN 'captcha'
        WHEN contains({low}, 'just a moment...') OR contains({low}, 'attention required! | cloudflare') THEN 'blocked'
        WHEN octet_length(html) < 2000 AND contains({low}, 'document.cookie') AND contains({low}, 'location.reload') THEN 'blocked'
        WHEN s IN (403, 429) THEN 'blocked' WHEN s IN (404, 410) THEN 'notfound' WHEN s >= 500 THEN 'error' WHEN s >= 400 THEN 'http4xx'
        WHEN {_NON_HTML} THEN 'nonhtml' ELSE 'ok' END"""


_FETCH2 = f"SELECT *, lower(coalesce(ctype, '')) AS ct, {_hex_head('html')} AS hx FROM ({_FETCH_SQL})"
_DONE = "('ok','notfound','home','robots','http4xx','nonhtml')"
_STRIP = "regexp_replace(regexp_replace(h, '(?is)<style\\b.*?</style>|<svg\\b.*?</svg>|<!--.*?-->', '', 'g'), '^$', '')"
_ONE = "SELECT source, id, decode(min(html)) AS h FROM pages WHERE html IS NOT NULL GROUP BY source, id"
SQL = {
    "classify_kind": f"""SELECT source, id, min(CASE WHEN k = 'ok' AND {Q.is_home('url', 'f')} THEN 'home' ELSE k END) AS kind
        FROM (SELECT *, {_kind(True)} AS k FROM ({_FETCH2})) GROUP BY source, id""",
    "classify_kind_plain": f"SELECT {_kind(False)} AS kind, count(*) AS n FROM ({_FETCH2}) GROUP BY 1",
    "non_html_magic": f"""SELECT source, kind, count(*) FILTER (WHERE {_NON_HTML}) AS n_non_html, count(*) AS n FROM (
        SELECT source, kind, coalesce(final_url, url) AS f, lower(coalesce(ctype, '')) AS ct,
            CASE WHEN id % 5 = 0 THEN {[m.hex().upper() for m in C.MAGIC]}[(id % 6 + 1)::INT] ELSE {_hex_head("coalesce(html, ''::BLOB)")} END AS hx FROM pages)
        GROUP BY source, kind""",
    "strip_html_bytes": f"SELECT source, id, CAST(octet_length(encode({_STRIP})) AS BIGINT) AS n_bytes, md5({_STRIP}) AS md5 FROM ({_ONE})",
    "page_title": f"""SELECT source, id, left(regexp_replace(regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1), '^\\s+|\\s+$', '', 'g'), 60) AS title FROM ({_ONE})""",
    "upsert_latest": """SELECT source, id, kind, status, attempts, fetched_at FROM pages
        QUALIFY row_number() OVER (PARTITION BY source, id ORDER BY fetched_at DESC, attempts DESC, kind, final_url ASC NULLS LAST) = 1""",
    "pending_antijoin": f"""SELECT c.id, coalesce(a.attempts, 0) AS attempts FROM corpus c LEFT JOIN (SELECT id, max(attempts) AS attempts FROM pages GROUP BY id) a USING (id)
        WHERE c.id NOT IN (SELECT id FROM pages WHERE kind IN {_DONE} OR attempts >= 5)""",
    "attempts_exhausted": f"SELECT id, max(attempts) AS attempts FROM pages GROUP BY id HAVING max(attempts) >= 5 AND NOT max(kind IN {_DONE})",
    "stored_semi": "SELECT id, url FROM corpus WHERE id IN (SELECT id FROM pages WHERE kind = 'ok')",
    "done_definitions": f"""SELECT count(*) FILTER (WHERE a) AS resume, count(*) FILTER (WHERE b) AS archive_guard, count(*) FILTER (WHERE c) AS index_have,
        count(*) FILTER (WHERE e) AS missing_pass, count(*) FILTER (WHERE f) AS coverage_dead, count(*) FILTER (WHERE g) AS progress FROM (
        SELECT id, max(kind IN {_DONE} OR attempts >= 5) AS a, max(kind = 'ok') AS b, max(kind IN ('ok','notfound','home')) AS c,
            max(source = 'db' AND kind = 'ok' AND html IS NOT NULL) AS e, max(source = 'db' AND kind IN ('notfound','home','http4xx')) AS f,
            max(kind IN ('ok','notfound','home','robots','http4xx')) AS g FROM pages GROUP BY id)""",
    "corrective_update": f"""SELECT source, CASE WHEN bad THEN 'nonhtml' ELSE 'ok' END AS kind, count(*) AS n, count(*) FILTER (WHERE NOT bad) AS n_bodies,
        count(*) FILTER (WHERE bad) AS n_corrected FROM (SELECT source, regexp_matches({Q.path('f')}, {Q.EXT}) AS bad FROM ({_FETCH_SQL.replace('WHERE html IS NOT NULL', "WHERE kind = 'ok'")})) GROUP BY 1, 2""",
    "normalised_failures": """SELECT source, kind, count(*) FILTER (WHERE status IS NOT NULL AND status <> -1) AS n_status,
        count(*) FILTER (WHERE final_url IS NOT NULL AND status IS DISTINCT FROM -1) AS n_final, count(*) AS n FROM pages GROUP BY source, kind""",
    "body_cap": """SELECT source, CAST(sum(least(octet_length(html), 2000)) AS BIGINT) AS kept, CAST(sum(nbytes) AS BIGINT) AS reported,
        count(*) FILTER (WHERE octet_length(html) >= 2000) AS n_cut FROM pages WHERE html IS NOT NULL GROUP BY source""",
}
