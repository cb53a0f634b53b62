"""Books whose chapters were renumbered on a new site: old addresses of their pages from catalogs and archives.

A book is a section and a slug; its pages end in ``/<section>/<slug>/<number>``.
Each step is a join on a key; where several candidates may answer, they are
tried in the order given and the first that an archive holds wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import URL_RX


def book_parts(url: Column) -> Column:
    """Struct of the last three segments (section, slug, number as a long or NULL)."""
    parts = F.split(F.regexp_replace(url, "/+$", ""), "/")
    part = lambda n: F.try_element_at(parts, F.lit(n))
    return F.struct(part(-3).alias("section"), part(-2).alias("slug"), part(-1).try_cast("long").alias("number"))


def bare_slug(slug: Column) -> Column:
    """Slug without the digits at its end."""
    return F.regexp_replace(slug, r"[0-9]+$", "")


def old_path(url: Column) -> Column:
    """Path of an archived address without its scheme, host, port and query."""
    return F.split_part(F.regexp_extract(url, URL_RX, 2), F.lit("?"), F.lit(1))


def from_template(template: str, slug: Column) -> Column:
    """Address path from a template with ``{slug}`` and ``{first}`` (the slug's first letter)."""
    pieces: list[Column] = []
    rest = template
    while rest:
        at = min((i for i in (rest.find("{slug}"), rest.find("{first}")) if i >= 0), default=-1)
        if at < 0:
            pieces.append(F.lit(rest))
            break
        if at:
            pieces.append(F.lit(rest[:at]))
        name, rest = rest[at : rest.index("}", at) + 1], rest[rest.index("}", at) + 1 :]
        pieces.append(slug if name == "{slug}" else F.substring(slug, 1, 1))
    return F.concat(*pieces)


def templated(pages: DataFrame, templates: dict[str, str]) -> Column:
    """Old path of pages of the sections that have a template, NULL elsewhere and for empty slugs."""
    out = F.lit(None).cast("string")
    for section, template in templates.items():
        out = F.when((F.col("section") == section) & (F.col("slug") != ""), from_template(template, F.col("slug"))).otherwise(out)
    return out


def catalog_name(section: Column, slug: Column, plain: str) -> Column:
    """Name of a book's catalog file: the slug alone for the plain section, else behind its section."""
    return F.concat(F.when(section != plain, F.concat(section, F.lit("_"))).otherwise(F.lit("")), slug, F.lit(".html"))


def report_name(section: Column, slug: Column, plain: str) -> Column:
    """Name of a book in reports."""
    return F.when(section == plain, slug).otherwise(F.concat(section, F.lit("/"), slug))


def first_hit(rows: DataFrame, candidates: list[Column], known: DataFrame, keys: tuple[str, ...], found: str = "found") -> DataFrame:
    """Rows with the first of their candidates that is among ``known`` (a column ``candidate``), NULL without one.

    All candidates go through one join; a row's hits are reduced by their rank. ``keys`` identify a row.
    """
    listed = F.array(*[F.struct(F.lit(i).alias("rank"), c.alias("candidate")) for i, c in enumerate(candidates)])
    tried = rows.select(*keys, F.explode(listed).alias("x")).select(*keys, "x.rank", "x.candidate").where("candidate is not null")
    hits = tried.join(known.select("candidate").distinct(), "candidate", "left_semi").groupBy(*keys).agg(F.min_by("candidate", "rank").alias(found))
    return rows.join(hits, list(keys), "left")


def newest_paths(captures: DataFrame, before: str | None = None) -> DataFrame:
    """``candidate, ts, original``: the newest capture of each old path, optionally of those before a time; ties by address."""
    rows = captures.where(F.col("ts") < before) if before else captures
    return rows.groupBy(old_path(F.col("original")).alias("candidate")).agg(F.max(F.struct("ts", "original")).alias("x")).select("candidate", "x.*")


def chapters(aligned: DataFrame, ids: DataFrame, entries: DataFrame) -> DataFrame:
    """``book, new_id, url, si, href``: pages of aligned books that fall on an entry with a chapter.

    The entry of a page is its number less the book's shift; of entries with
    one number the last in the catalog counts, also where it has no chapter.
    """
    w = Window.partitionBy("book", "si").orderBy(F.desc("pos"))
    last = entries.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("book", "si", "href")
    shift = aligned.where("status = 'aligned'").select("book", "shift")
    return ids.join(shift, "book").withColumn("si", F.col("new_id") - F.col("shift")).join(last, ["book", "si"]).where("href is not null").select("book", "new_id", "url", "si", "href", "shift")


def book_map(found: DataFrame, captures: DataFrame, fallback: Column, before: str | None = None) -> DataFrame:
    """``url, archived_url, method`` of chapters an archive holds under their own path or else the fallback's."""
    known = newest_paths(captures, before)
    own = old_path(F.col("href"))
    hit = first_hit(found.withColumn("own", own).withColumn("other", fallback), [F.col("own"), F.col("other")], known, ("book", "new_id"), "candidate")
    return hit.where("candidate is not null").join(known, "candidate").select("url", F.col("original").alias("archived_url"), F.concat(F.lit("book-si k="), "shift").alias("method"))
