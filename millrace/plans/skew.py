"""Per-host figures of the fetch log, exact for all hosts whatever their size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import site
from ..operators.keyed_sums import keyed_sums
from ..session import table

#: Share of all rows from which a host counts as hot.
HOT_SHARE = 0.05


def host_sums(spark: SparkSession, d: str) -> DataFrame:
    """Rows, stored rows, failures and bytes per host of ``pages.url``."""
    pages = table(spark, d, "pages").select("url", "kind", "nbytes", "attempts").withColumn("host", site("url"))
    return keyed_sums(
        pages,
        "host",
        {
            "n_ok": (F.col("kind") == "ok").cast("long"),
            "n_error": F.col("kind").isin("error", "blocked", "captcha").cast("long"),
            "n_bytes": F.col("nbytes"),
            "n_attempts": F.col("attempts"),
        },
    )


def p1_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Every host's figures next to the earlier report's, matched on the clean host name.

    The report is matched on lower-case trimmed names; its indented sub-rows
    are left out and repeated rows count once.
    """
    report = (
        table(spark, d, "coverage")
        .where(~F.col("host").startswith(" "))
        .select(F.regexp_replace(F.lower(F.trim("host")), r"^www\.", "").alias("host"), "total", "stored")
        .groupBy("host")
        .agg(F.max("total").alias("reported_total"), F.max("stored").alias("reported_stored"))
    )
    return host_sums(spark, d).join(report, "host", "left")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Hosts with at least 5 % of all rows."""
    sums = host_sums(spark, d)
    total = sums.agg(F.sum("n_rows").alias("all_rows"))  # one row
    return sums.join(F.broadcast(total)).where(F.col("n_rows") >= HOT_SHARE * F.col("all_rows")).select("host")


_SITE = (
    "regexp_replace(lower(regexp_replace(regexp_replace(regexp_extract(ltrim(url), "
    r"'^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?', 1), '^.*@', ''), ':[0-9]*$', '')), '^www\.', '')"
)

QUERIES = {"p1_found": p1_found, "p1_hosts": p1_hosts}
SQL = {
    "p1_found": f"SELECT {_SITE} AS host FROM pages GROUP BY 1 HAVING count(*) >= 0.05 * (SELECT count(*) FROM pages)",
    "p1_hosts": f"""
        WITH r AS (SELECT regexp_replace(lower(trim(host)), '^www\\.', '') AS host, max(total) AS reported_total, max(stored) AS reported_stored
                   FROM coverage WHERE NOT starts_with(host, ' ') GROUP BY 1),
             s AS (SELECT {_SITE} AS host, count(*) AS n_rows, CAST(sum((kind = 'ok')::INT) AS BIGINT) AS n_ok,
                          CAST(sum((kind IN ('error', 'blocked', 'captcha'))::INT) AS BIGINT) AS n_error,
                          CAST(sum(nbytes) AS BIGINT) AS n_bytes, CAST(sum(attempts) AS BIGINT) AS n_attempts
                   FROM pages GROUP BY 1)
        SELECT s.*, r.reported_total, r.reported_stored FROM s LEFT JOIN r USING (host)""",
}
