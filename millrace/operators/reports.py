"""Coverage, missing-page, redirect and progress reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import redirect_kind, unwrapped
from .store import DEAD_KINDS
from .windows import batches

STATES = ("stored", "dead", "robots", "queued_archive", "no_source", "queued_direct")
REDIRECTS = ("same_article", "different_article", "non_html")
PROGRESS_KINDS = ("ok", "notfound", "home", "robots", "http4xx", "error", "blocked", "captcha")


def page_states(corpus: DataFrame, log: DataFrame, archived: DataFrame, problem: Column, disallowed: Column) -> DataFrame:
    """Corpus rows (``id, url, host``) with their state.

    stored anywhere > dead at the origin > robots > rest; on problem hosts the
    rest is split by whether an archive holds the page, elsewhere it is queued.
    The log is reduced to one row of flags per id before the join.
    """
    origin = F.col("source") == "db"
    flags = log.groupBy("id", "host").agg(
        F.max(F.col("kind") == "ok").alias("is_ok"),
        F.max(origin & F.col("kind").isin(*DEAD_KINDS)).alias("is_dead"),
        F.max(origin & (F.col("kind") == "robots")).alias("is_robots"),
    )
    joined = corpus.join(flags, ["id", "host"], "left").join(archived.select("id").distinct().withColumn("has_archive", F.lit(True)), "id", "left")
    state = (
        F.when(F.coalesce("is_ok", F.lit(False)), "stored")
        .when(F.coalesce("is_dead", F.lit(False)), "dead")
        .when(F.coalesce("is_robots", F.lit(False)) | disallowed, "robots")
        .when(problem & F.coalesce("has_archive", F.lit(False)), "queued_archive")
        .when(problem, "no_source")
        .otherwise("queued_direct")
    )
    return joined.select("id", "url", "host", state.alias("state"), F.coalesce("has_archive", F.lit(False)).alias("has_archive"))


def coverage(states: DataFrame, key: str = "host") -> DataFrame:
    """Counts of every state per key, in one aggregation."""
    return states.groupBy(key).agg(F.count("*").alias("total"), *[F.count_if(F.col("state") == s).alias(s) for s in STATES])


def totals(report: DataFrame) -> DataFrame:
    """One row: the sum of every counter."""
    return report.agg(*[F.sum(c).cast("long").alias(c) for c in ("total", *STATES)])


def sections(states: DataFrame, section: Column) -> DataFrame:
    """Sub-rows by section: what is not stored is archive-queued or without a source, nothing else."""
    rest = F.col("state") != "stored"
    return states.groupBy(section.alias("section")).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("state") == "stored").alias("stored"),
        F.count_if(rest & F.col("has_archive")).alias("queued_archive"),
        F.count_if(rest & ~F.col("has_archive")).alias("no_source"),
    )


def main_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent value per key; ties go to the value first in order."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(key).orderBy(F.desc("n"), F.asc(value))
    return counts.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def redirected(log: DataFrame, skip_sources: tuple[str, ...] = ("db_alt",)) -> DataFrame:
    """Stored pages whose content came from another address, with the kind of redirect."""
    final = F.when(F.col("source") == "db_wayback", unwrapped("final_url")).otherwise(F.col("final_url"))
    rows = log.where((F.col("kind") == "ok") & F.coalesce(F.col("final_url") != "", F.lit(False)) & ~F.col("source").isin(*skip_sources))
    return rows.select("id", "url", final.alias("final_url"), "host", "source").withColumn("redirect", redirect_kind("url", "final_url")).where("redirect is not null")


def redirect_table(red: DataFrame) -> DataFrame:
    """Host x kind of redirect; the value list is explicit, so no extra pass finds it."""
    return red.groupBy("host").pivot("redirect", list(REDIRECTS)).agg(F.count("redirect")).na.fill(0, list(REDIRECTS))


def sorted_redirects(red: DataFrame) -> DataFrame:
    """The table with ``place`` from 0: most different articles first, then files, then same articles, then by host."""
    down = [(-F.col(c)).alias(f"_{c}") for c in ("different_article", "non_html", "same_article")]
    rows = batches(redirect_table(red).select("*", *down), ("_different_article", "_non_html", "_same_article", "host"), 1)
    return rows.withColumnRenamed("batch", "place").drop("_different_article", "_non_html", "_same_article")


def progress(log: DataFrame, corpus_totals: DataFrame) -> DataFrame:
    """Per host: counts by kind, share done in percent, stored MB, next to the corpus total."""
    counts = log.groupBy("host").agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in PROGRESS_KINDS], F.sum("nbytes").alias("n_bytes")
    )
    done = sum((F.col(k) for k in ("ok", "notfound", "home", "robots", "http4xx")), F.lit(0))
    return (
        counts.join(corpus_totals, "host", "left")
        .withColumn("total", F.coalesce("total", F.lit(0)))
        .withColumn("done_pct", F.when(F.col("total") > 0, F.round(100 * done / F.col("total"), 4)))
        .withColumn("mb", F.round(F.col("n_bytes") / (1 << 20)).cast("long"))
        .drop("n_bytes")
    )


def prefix_plan(urls: DataFrame, host: str, segment: str, min_urls: int = 50, min_share: float = 0.95) -> DataFrame:
    """Per host: big path prefixes if they cover enough, else the whole host."""
    counts = urls.groupBy(host, segment).agg(F.count("*").alias("n"))
    big = (F.col(segment) != "") & (F.col("n") >= min_urls)
    return counts.groupBy(host).agg(
        F.sum("n").cast("long").alias("n_urls"),
        F.coalesce(F.sum(F.when(big, F.col("n"))), F.lit(0)).cast("long").alias("n_covered"),
        F.count_if(big).alias("n_prefixes"),
    ).withColumn("by_prefix", F.col("n_covered") >= min_share * F.col("n_urls"))
