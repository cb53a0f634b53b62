"""The page store as an append-only fetch log: newest row per page, resume rules, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import is_non_html
from ..functions.urls import canonical, unwrapped

MAX_ATTEMPTS = 5
DONE_KINDS = ("ok", "notfound", "home", "robots", "http4xx", "nonhtml")
#: The different meanings of "done"; they are kept apart on purpose.
ARCHIVE_HAVE = ("ok", "notfound", "home")
DEAD_KINDS = ("notfound", "home", "http4xx")


def latest(log: DataFrame, keys: tuple[str, ...] = ("source", "id"), order: tuple[Column, ...] = ()) -> DataFrame:
    """Upsert view: the last row written per key; ties settled by ``order``.

    Only one row per key and split leaves a split: the window is limited to its
    first row before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*(order or (F.desc("fetched_at"), F.desc("attempts"), F.asc("kind"), F.asc_nulls_last("final_url"))))
    return log.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def done_ids(log: DataFrame, kinds: tuple[str, ...] = DONE_KINDS, max_attempts: int | None = MAX_ATTEMPTS) -> DataFrame:
    """Ids that need no further fetch: a final kind, or attempts used up."""
    rule = F.col("kind").isin(*kinds)
    if max_attempts is not None:
        rule = rule | (F.col("attempts") >= max_attempts)
    return log.where(rule).select("id").distinct()


def stored_ids(log: DataFrame, sources: tuple[str, ...] = ()) -> DataFrame:
    """Ids with an ``ok`` row in any (of the given) sources."""
    ok = log.where("kind = 'ok'")
    return (ok.where(F.col("source").isin(*sources)) if sources else ok).select("id").distinct()


def pending(corpus: DataFrame, log: DataFrame) -> DataFrame:
    """Corpus rows not done, with the attempts so far (0 without a row)."""
    tried = log.groupBy("id").agg(F.max("attempts").alias("attempts"))
    return (
        corpus.join(done_ids(log), "id", "left_anti")
        .join(tried, "id", "left")
        .withColumn("attempts", F.coalesce("attempts", F.lit(0)))
    )


def corrected(log: DataFrame, wrong: Column, kind: str) -> DataFrame:
    """Log with the kind of wrong rows replaced and their body dropped."""
    bad = F.coalesce(wrong, F.lit(False))
    out = log.withColumn("corrected", bad).withColumn("kind", F.when(bad, kind).otherwise(F.col("kind")))
    return out.withColumn("html", F.when(~bad, F.col("html"))) if "html" in log.columns else out


def non_html_rows(log: DataFrame) -> Column:
    """Stored rows that are no page: by final address, first bytes and, where the origin answered, content type.

    An archive's answer carries the archive's own type, so the type counts for origin and alternate sources only.
    """
    final = F.when(F.col("source") == "db_wayback", unwrapped(F.coalesce("final_url", F.lit("")))).otherwise(F.coalesce("final_url", F.lit("")))
    ctype = F.when(F.col("source").isin("db", "db_alt"), F.col("ctype"))
    return (F.col("kind") == "ok") & is_non_html(final, ctype, F.coalesce("html", F.lit("").cast("binary")))


def unmapped_rows(log: DataFrame, expected: DataFrame, sources: tuple[str, ...] = ("db_wayback", "db_cc")) -> DataFrame:
    """The log with ``_wrong``: stored archive rows whose address is not the one their page maps to (``id, key``); no mapping
    and no address count as the empty one."""
    got = canonical(unwrapped(F.coalesce("final_url", F.lit(""))))
    rows = log.join(expected.select("id", F.col("key").alias("_key")), "id", "left")
    wrong = (F.col("kind") == "ok") & F.col("source").isin(*sources) & (got != F.coalesce("_key", F.lit("")))
    return rows.withColumn("_wrong", F.coalesce(wrong, F.lit(False))).drop("_key")


def repaired(log: DataFrame, wrong: Column, kind: str) -> DataFrame:
    """Every row of the (source, host) partitions that hold a wrong row, with those rows corrected; what to write back.

    The partitions touched are found from the narrow columns; their number is that of a report, not of rows.
    """
    touched = log.where(wrong).select("source", "host").distinct()
    return corrected(log.join(touched, ["source", "host"], "left_semi"), wrong, kind)


def normalised(log: DataFrame) -> DataFrame:
    """Transport failures as NULL: status -1 means none, and so does the final address of such a row."""
    failed = F.col("status") == -1
    return log.withColumn("final_url", F.when(failed, F.lit(None)).otherwise(F.col("final_url"))).withColumn(
        "status", F.when(failed, F.lit(None)).otherwise(F.col("status"))
    )
