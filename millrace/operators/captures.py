"""Matching a list of wanted addresses against archive indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import canonical

#: Records below this many bytes are stubs of redirects and challenges.
MIN_RECORD = 1500


def wanted_keys(corpus: DataFrame, alternates: DataFrame | None = None) -> DataFrame:
    """``key, id, url, prio``: one page per key. The direct address wins over
    alternates; of several pages with one direct key the last one wins, of
    several alternates the first."""
    direct = corpus.select(canonical("url").alias("key"), "id", "url", F.lit(0).alias("prio"), (-F.col("id")).alias("rank"))
    keys = direct
    if alternates is not None:
        alt = alternates.join(corpus.select(F.col("id"), F.col("url").alias("corpus_url")), "corpus_url").select(
            canonical("archived_url").alias("key"), "id", F.col("corpus_url").alias("url"), F.col("prio"), F.col("id").alias("rank")
        )
        keys = direct.unionByName(alt)
    first = F.min_by(F.struct("id", "url", "prio"), F.struct("prio", "rank"))  # reduced within each split first
    return keys.groupBy("key").agg(first.alias("x")).select("key", "x.*")


def before(captures: DataFrame, cutoffs: dict[str, str], host: Column) -> DataFrame:
    """Captures before the cutoff of their host; times compare as strings."""
    if not cutoffs:
        return captures
    limit = F.create_map(*[F.lit(x) for kv in cutoffs.items() for x in kv])
    c = F.try_element_at(limit, host)
    return captures.where(c.isNull() | (F.col("ts") < c))


def newest(matches: DataFrame, k: int, keys: tuple[str, ...] = ("id",), order: tuple[str, ...] = ("ts", "original")) -> DataFrame:
    """The k newest distinct captures per page, numbered from 1."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return matches.distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def usable_records(index: DataFrame, min_record: int = MIN_RECORD) -> DataFrame:
    """Records large enough to hold a page; a record without a length is none."""
    return index.where(F.col("length") >= min_record)


def first_accepted(candidates: DataFrame, accept: Column, key: str = "id", rank: str = "rank") -> DataFrame:
    """The best-ranked candidate that is accepted; one row per key, ``NULL`` fields without one."""
    fields = [c for c in candidates.columns if c not in (key,)]
    best = candidates.where(accept).groupBy(key).agg(F.min_by(F.struct(*fields), F.col(rank)).alias("_b"))
    return candidates.select(key).distinct().join(best, key, "left").select(key, F.col("_b").isNotNull().alias("accepted"), *[F.col(f"_b.{c}").alias(c) for c in fields])
