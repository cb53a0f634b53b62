"""Queries that find old addresses of renumbered or renamed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import align as A
from ..operators import books as B
from ..session import table
from . import sqlparts as Q

#: Sections and their templates, and the section whose names stand alone (configuration of these queries).
TEMPLATES = {"tin": "/t/{first}/{slug}.html", "bai": "/b_{first}/{slug}.html", "article": "/a/{slug}.htm"}
PLAIN = "tin"


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus")


def _slugs(spark: SparkSession, d: str) -> DataFrame:
    slug = F.regexp_replace(U.last_segment(U.url_path("url")), r"\.\w{2,5}$", "")
    return _corpus(spark, d).select("id", "url", F.split_part(U.url_path("url"), F.lit("/"), F.lit(2)).alias("section"), slug.alias("slug"))


def book_parts(spark: SparkSession, d: str) -> DataFrame:
    """Last three segments of every address, the last as a number where it is one."""
    c = _corpus(spark, d).select("id", F.regexp_replace("url", r"[?#].*$|\.html?$", "").alias("u"))
    return c.select("id", B.book_parts(F.col("u")).alias("p")).select("id", "p.*")


def slug_templates(spark: SparkSession, d: str) -> DataFrame:
    """Old path by the section's template."""
    s = _slugs(spark, d)
    return s.select("id", B.templated(s, TEMPLATES).alias("old_path"))


def slug_by_number(spark: SparkSession, d: str) -> DataFrame:
    """Old paths of articles by their number: an archived path is looked up by the number in it, the later capture's path wins."""
    number = lambda c: F.regexp_extract(c, r"(\d{5,})", 1)
    arch = table(spark, d, "cdx").select(number(B.old_path(F.col("original"))).alias("n"), B.old_path(F.col("original")).alias("p"), "ts").where("n <> ''")
    latest = arch.groupBy("n").agg(F.max_by("p", F.struct("ts", "p")).alias("old_path"))
    c = _corpus(spark, d).select("id", number(U.url_path("url")).alias("n"))
    return c.join(latest, "n").select("id", "old_path")


def old_slugs(spark: SparkSession, d: str) -> DataFrame:
    """Slug of every page, else without the digits at its end, whichever an archived path has."""
    known = table(spark, d, "cdx").select(F.regexp_replace(U.last_segment(B.old_path(F.col("original"))), r"\.\w{2,5}$", "").alias("candidate")).where(F.col("candidate").rlike("^[a-z].*[0-9]$") | ~F.col("candidate").rlike("[0-9]$"))
    s = _slugs(spark, d).select("id", "slug")
    # every other slug gets digits that no archive has
    s = s.withColumn("slug", F.when(F.col("id") % 2 == 0, F.concat("slug", F.lit("77"))).otherwise(F.col("slug")))
    return B.first_hit(s, [F.col("slug"), B.bare_slug(F.col("slug"))], known, ("id",), "old_slug").select("id", "old_slug")


def catalog_names(spark: SparkSession, d: str) -> DataFrame:
    """Catalog files and report names of all books."""
    s = _slugs(spark, d).where("slug <> '' and section <> ''")
    return s.groupBy(B.catalog_name(F.col("section"), F.col("slug"), PLAIN).alias("file"), B.report_name(F.col("section"), F.col("slug"), PLAIN).alias("book")).agg(F.count("*").alias("n"))


# Books with catalogs and archives derived from the corpus: a book per site, chapters at id % 97, renumbered by a shift.
def _numbers(spark: SparkSession, d: str) -> DataFrame:
    return _corpus(spark, d).select(U.site("url").alias("book"), (F.col("id") % 97).alias("si")).distinct()


def _entries(spark: SparkSession, d: str) -> DataFrame:
    """Catalog entries: every third has no chapter, every tenth stands twice with another chapter."""
    b = _numbers(spark, d)
    n = F.col("si").cast("string")
    one = b.select("book", "si", F.lit(0).alias("pos"), F.when(F.col("si") % 3 != 0, F.concat(F.lit("http://old.example:80/c/"), n, F.lit(".html"))).alias("href"))
    two = b.where("si % 10 = 4").select("book", "si", F.lit(1).alias("pos"), F.when(F.col("si") % 3 != 0, F.concat(F.lit("/d/"), n, F.lit(".html"))).alias("href"))
    return one.unionByName(two)


def _ids(spark: SparkSession, d: str) -> DataFrame:
    b = _numbers(spark, d).where("si % 3 <> 0")
    new = F.col("si") + F.length("book") % 7
    return b.select("book", new.alias("new_id"), F.concat(F.lit("http://"), "book", F.lit("/"), new.cast("string")).alias("url"))


def _found(spark: SparkSession, d: str) -> DataFrame:
    entries = _entries(spark, d)
    items = entries.select("book", "si", F.col("href").isNotNull().alias("content")).distinct()
    ids = _ids(spark, d)
    return B.chapters(A.align(items, ids.select("book", "new_id")), ids, entries)


def chapter_links(spark: SparkSession, d: str) -> DataFrame:
    """Each page of an aligned book with the chapter of its entry."""
    return _found(spark, d).select("book", "new_id", "si", "href")


def book_map(spark: SparkSession, d: str) -> DataFrame:
    """Archived addresses of chapters: their own path, else the book's numbered page; captures after the cutoff do not count."""
    b = _numbers(spark, d)
    n = F.col("si").cast("string")
    own = b.where("si % 4 = 0").select(F.concat(F.lit("2019"), n).alias("ts"), F.concat(F.lit("http://www.old.example/c/"), n, F.lit(".html?x=1")).alias("original"))
    other = b.where("si % 2 = 1").select(F.concat(F.lit("2020"), n).alias("ts"), F.concat(F.lit("http://old.example:80/l/"), "book", F.lit("/"), n, F.lit(".html")).alias("original"))
    late = b.where("si % 2 = 0").select(F.lit("2026").alias("ts"), F.concat(F.lit("http://old.example/l/"), "book", F.lit("/"), n, F.lit(".html")).alias("original"))
    fallback = F.concat(F.lit("/l/"), "book", F.lit("/"), F.col("si").cast("string"), F.lit(".html"))
    return B.book_map(_found(spark, d), own.unionByName(other).unionByName(late), fallback, before="2025")


QUERIES = {f.__name__: f for f in (book_parts, slug_templates, slug_by_number, old_slugs, catalog_names, chapter_links, book_map)}

_U = r"regexp_replace(url, '[?#].*$|\.html?$', '', 'g')"
_P = f"string_split(regexp_replace({_U}, '/+$', ''), '/')"
_SLUG = f"(SELECT id, split_part({Q.path('url')}, '/', 2) AS section, regexp_replace({Q.last(Q.path('url'))}, '\\.\\w{{2,5}}$', '') AS slug FROM corpus)"
_OLD = f"regexp_extract(original, {Q.RX}, 2)"
_NAME = f"regexp_replace({Q.last(_OLD)}, '\\.\\w{{2,5}}$', '')"
_NUM = f"(SELECT DISTINCT {Q.site('url')} AS book, id % 97 AS si FROM corpus)"
# the last entry of a number counts; only books with one exact shift
_LINK = f"""(WITH b AS {_NUM}, c AS (SELECT book, si FROM b WHERE si % 3 <> 0), f AS (SELECT book, min(si) AS first_si, count(*) AS n FROM c GROUP BY 1),
    h AS (SELECT f.book, f.first_si - c1.si AS k, count(*) AS hits FROM f JOIN c c1 USING (book) JOIN c c2 ON c2.book = f.book JOIN c c3 ON c3.book = f.book AND c3.si = c2.si - (f.first_si - c1.si) GROUP BY 1, 2),
    good AS (SELECT h.book FROM h JOIN f USING (book) GROUP BY 1 HAVING count(*) FILTER (WHERE hits / n >= 0.995) = 1)
    SELECT c.book, c.si + length(c.book) % 7 AS new_id, c.si, length(c.book) % 7 AS shift,
        CASE WHEN c.si % 10 = 4 THEN '/d/' || c.si || '.html' ELSE 'http://old.example:80/c/' || c.si || '.html' END AS href FROM c JOIN good USING (book))"""
SQL = {
    "book_parts": f"""SELECT id, CASE WHEN len({_P}) >= 3 THEN {_P}[-3] END AS section, CASE WHEN len({_P}) >= 2 THEN {_P}[-2] END AS slug,
        TRY_CAST(CASE WHEN regexp_full_match({_P}[-1], '[+-]?\\d+') THEN {_P}[-1] END AS BIGINT) AS number FROM corpus""",
    "slug_templates": f"""SELECT id, CASE WHEN slug = '' THEN NULL WHEN section = 'tin' THEN '/t/' || slug[1:1] || '/' || slug || '.html' WHEN section = 'bai' THEN '/b_' || slug[1:1] || '/' || slug || '.html'
        WHEN section = 'article' THEN '/a/' || slug || '.htm' END AS old_path FROM {_SLUG}""",
    "slug_by_number": f"""WITH a AS (SELECT regexp_extract(p, '(\\d{{5,}})', 1) AS n, arg_max(p, (ts, encode(p))) AS old_path FROM (SELECT {_OLD} AS p, ts FROM cdx) GROUP BY 1 HAVING n <> '')
        SELECT c.id, a.old_path FROM corpus c JOIN a ON a.n = regexp_extract({Q.path('c.url')}, '(\\d{{5,}})', 1)""",
    "old_slugs": f"""WITH k AS (SELECT DISTINCT {_NAME} AS c FROM cdx), kk AS (SELECT c FROM k WHERE regexp_matches(c, '^[a-z].*[0-9]$') OR NOT regexp_matches(c, '[0-9]$')),
        s AS (SELECT id, CASE WHEN id % 2 = 0 THEN slug || '77' ELSE slug END AS slug FROM {_SLUG})
        SELECT id, CASE WHEN slug IN (SELECT c FROM kk) THEN slug WHEN regexp_replace(slug, '[0-9]+$', '') IN (SELECT c FROM kk) THEN regexp_replace(slug, '[0-9]+$', '') END AS old_slug FROM s""",
    "catalog_names": f"""SELECT CASE WHEN section = 'tin' THEN '' ELSE section || '_' END || slug || '.html' AS file, CASE WHEN section = 'tin' THEN slug ELSE section || '/' || slug END AS book, count(*) AS n
        FROM {_SLUG} WHERE slug <> '' AND section <> '' GROUP BY 1, 2""",
    "chapter_links": f"SELECT book, new_id, si, href FROM {_LINK}",
    "book_map": f"""SELECT 'http://' || book || '/' || new_id AS url, CASE WHEN si % 10 <> 4 AND si % 4 = 0 THEN 'http://www.old.example/c/' || si || '.html?x=1' ELSE 'http://old.example:80/l/' || book || '/' || si || '.html' END AS archived_url,
        'book-si k=' || shift AS method FROM {_LINK} WHERE (si % 10 <> 4 AND si % 4 = 0) OR si % 2 = 1""",
}
