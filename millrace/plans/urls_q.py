"""Queries over addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..session import table
from . import sqlparts as Q

#: Articles whose number is their identity under another address scheme.
NUMBERED = r"/tin/(\d+)/"


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus")


def host_parse(spark: SparkSession, d: str) -> DataFrame:
    return _corpus(spark, d).select(
        "id", U.host_key("url").alias("host"), U.hostname("url").alias("hostname"), U.url_path("url").alias("path"), U.url_query("url").alias("query")
    )


def site_group(spark: SparkSession, d: str) -> DataFrame:
    h = _corpus(spark, d).select(U.hostname("url").alias("host"))
    return h.groupBy(U.site_group("host").alias("site_group")).agg(F.count("*").alias("n"), F.count_distinct("host").alias("n_hosts"))


def group_limits(spark: SparkSession, d: str) -> DataFrame:
    """Dimension lookup with a default: configured rate of a group, else the default one."""
    conf = spark.createDataFrame([("yte-humoti3.test", 16.0, 40), ("health-dola4.invalid", 4.0, 8)], "site_group string, rate double, conc int")
    g = _corpus(spark, d).select(U.site_group(U.hostname("url")).alias("site_group")).groupBy("site_group").agg(F.count("*").alias("queue"))
    return g.join(F.broadcast(conf), "site_group", "left").select(
        "site_group", "queue", F.coalesce("rate", F.lit(2.0)).alias("rate"), F.coalesce("conc", F.lit(4)).alias("conc")
    )


def url_norm(spark: SparkSession, d: str) -> DataFrame:
    return _corpus(spark, d).select("id", U.canonical("url").alias("key"))


def surt_key(spark: SparkSession, d: str) -> DataFrame:
    return _corpus(spark, d).select("id", U.surt(U.hostname("url"), F.regexp_replace(U.url_path("url"), "^/", "")).alias("key"))


def url_key(spark: SparkSession, d: str) -> DataFrame:
    return _corpus(spark, d).select("id", U.site("url").alias("host"), U.article_path("url").alias("path"))


def capture_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cdx").select(U.capture_key("original", NUMBERED, "tin-id").alias("key")).groupBy("key").agg(F.count("*").alias("n"))


def slug_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _corpus(spark, d).select("id", F.array_join(F.array_sort(U.slug_tokens(U.article_path("url"))), " ").alias("tokens"))


def alt_url(spark: SparkSession, d: str) -> DataFrame:
    return _corpus(spark, d).select("id", U.flat_address("url", "mirror.example").alias("alternate"))


def is_home(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").where("final_url is not null").select("source", "id", "url", "final_url")
    return p.select("source", "id", U.is_home("url", "final_url").alias("home"))


def redirect_kind(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of different addresses: each page against the next id's and against two rewrites."""
    c = _corpus(spark, d).select("id", "url")
    nxt = c.select((F.col("id") - 1).alias("id"), F.col("url").alias("final_url"))
    moved = c.select("id", F.concat(F.lit("https://moved.example"), U.url_path("url")).alias("final_url"))
    image = c.select("id", F.concat(F.lit("https://"), U.hostname("url"), F.lit("/img/"), "id", F.lit(".jpg")).alias("final_url"))
    pairs = c.join(nxt.unionByName(moved).unionByName(image), "id")
    return pairs.select("id", "final_url", U.redirect_kind("url", "final_url").alias("redirect"))


def suffix_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Hosts under a domain with and without the separating dot: the two predicates differ."""
    h = _corpus(spark, d).select(U.hostname("url").alias("host")).distinct()
    return h.select("host", F.col("host").endswith(".invalid").alias("under"), F.col("host").endswith("0.invalid").alias("ends"))


def page_numbers(spark: SparkSession, d: str) -> DataFrame:
    return _corpus(spark, d).select("id", U.page_number("url").alias("number"), U.first_segment("url").alias("segment"))


def url_filters(spark: SparkSession, d: str) -> DataFrame:
    """Include, exclude, substring and regular-expression predicates over the list."""
    c = _corpus(spark, d).withColumn("host", U.hostname("url"))
    hosts = c.groupBy("host").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "host").limit(3).select("host")
    hot = c.join(F.broadcast(hosts), "host", "left_anti")  # three rows
    return hot.where(F.col("url").contains("/tin/") | F.col("url").rlike(r"_\d+\.html")).select("id", "host")


QUERIES = {
    f.__name__: f
    for f in (
        host_parse, site_group, group_limits, url_norm, surt_key, url_key, capture_keys, slug_tokens, alt_url, is_home, redirect_kind, suffix_hosts,
        page_numbers, url_filters,
    )
}
_G = (
    "(CASE WHEN array_to_string(list_slice(l, -2, -1), '.') IN ('com.cn','com.vn','org.vn','gov.vn','edu.vn','net.vn','org.cn','gov.cn') "
    "THEN array_to_string(list_slice(l, -3, -1), '.') ELSE array_to_string(list_slice(l, -2, -1), '.') END)"
)
_H = f"SELECT {Q.hostname('url')} AS host, string_split({Q.hostname('url')}, '.') AS l FROM corpus"
SQL = {
    "host_parse": f"SELECT id, {Q.host_key('url')} AS host, {Q.hostname('url')} AS hostname, {Q.path('url')} AS path, {Q.query('url')} AS query FROM corpus",
    "site_group": f"SELECT {_G} AS site_group, count(*) AS n, count(DISTINCT host) AS n_hosts FROM ({_H}) GROUP BY 1",
    "group_limits": f"""SELECT site_group, queue,
        CASE site_group WHEN 'yte-humoti3.test' THEN 16.0 WHEN 'health-dola4.invalid' THEN 4.0 ELSE 2.0 END::DOUBLE AS rate,
        CASE site_group WHEN 'yte-humoti3.test' THEN 40 WHEN 'health-dola4.invalid' THEN 8 ELSE 4 END::INT AS conc
        FROM (SELECT {_G} AS site_group, count(*) AS queue FROM ({_H}) GROUP BY 1)""",
    "url_norm": f"SELECT id, {Q.canonical('url')} AS key FROM corpus",
    "surt_key": f"SELECT id, {Q.surt(Q.hostname('url'))} || regexp_replace({Q.path('url')}, '^/', '') AS key FROM corpus",
    "url_key": f"SELECT id, {Q.site('url')} AS host, {Q.article_path('url')} AS path FROM corpus",
    "capture_keys": f"""SELECT CASE WHEN regexp_extract(original, '/tin/(\\d+)/', 1) <> '' THEN 'tin-id:' || regexp_extract(original, '/tin/(\\d+)/', 1)
        ELSE {Q.canonical('original')} END AS key, count(*) AS n FROM cdx GROUP BY 1""",
    "slug_tokens": f"SELECT id, array_to_string(list_sort({Q.tokens(Q.article_path('url'))}), ' ') AS tokens FROM corpus",
    "alt_url": f"SELECT id, 'https://mirror.example/' || regexp_replace({Q.path('url')}, '^/+|/+$', '', 'g') || '.htm' AS alternate FROM corpus",
    "is_home": f"SELECT source, id, {Q.is_home('url', 'final_url')} AS home FROM pages WHERE final_url IS NOT NULL",
    "redirect_kind": f"""WITH p AS (
        SELECT a.id, a.url, b.url AS final_url FROM corpus a JOIN corpus b ON b.id = a.id + 1
        UNION ALL SELECT id, url, 'https://moved.example' || {Q.path('url')} FROM corpus
        UNION ALL SELECT id, url, 'https://' || {Q.hostname('url')} || '/img/' || id || '.jpg' FROM corpus)
        SELECT id, final_url, {Q.redirect_kind('url', 'final_url')} AS redirect FROM p""",
    "suffix_hosts": f"SELECT DISTINCT {Q.hostname('url')} AS host, ends_with({Q.hostname('url')}, '.invalid') AS under, ends_with({Q.hostname('url')}, '0.invalid') AS ends FROM corpus",
    "page_numbers": f"""SELECT id, CAST(list_extract(regexp_extract_all({Q.path('url')}, '\\d{{5,}}'), -1) AS BIGINT) AS number, {Q.segment('url')} AS segment FROM corpus""",
    "url_filters": f"""WITH c AS (SELECT id, url, {Q.hostname('url')} AS host FROM corpus),
        h AS (SELECT host FROM c GROUP BY host ORDER BY count(*) DESC, host LIMIT 3)
        SELECT id, host FROM c WHERE host NOT IN (SELECT host FROM h) AND (contains(url, '/tin/') OR regexp_matches(url, '_\\d+\\.html'))""",
}
