"""Queries that match the wanted list with archive indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import captures as C
from ..operators import ranges as R
from ..operators import reports, store
from ..session import table
from . import sqlparts as Q

CUTOFF = "20210101"
#: Captures of these hosts count before the cutoff only.
CUT_HOSTS = ("jiankang24teveha5.test", "m.wenyi-mago2.invalid")


def _wanted(spark: SparkSession, d: str) -> DataFrame:
    return C.wanted_keys(table(spark, d, "corpus"))


def _matches(spark: SparkSession, d: str) -> DataFrame:
    caps = C.before(table(spark, d, "cdx"), dict.fromkeys(CUT_HOSTS, CUTOFF), U.hostname("original"))
    return caps.withColumn("key", U.canonical("original")).join(_wanted(spark, d).select("key", "id"), "key").select("id", "ts", "original")


def capture_match(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d).groupBy("id").agg(F.count("*").alias("n_captures"), F.min("ts").alias("oldest"), F.max("ts").alias("newest"))


def capture_newest_k(spark: SparkSession, d: str) -> DataFrame:
    return C.newest(_matches(spark, d), 3).select("id", "rank", "ts", "original")


def capture_cutoff(spark: SparkSession, d: str) -> DataFrame:
    caps = C.before(table(spark, d, "cdx"), dict.fromkeys(CUT_HOSTS, CUTOFF), U.hostname("original"))
    return caps.groupBy(U.hostname("original").alias("host")).agg(F.count("*").alias("n"), F.max("ts").alias("newest"))


def key_priority_union(spark: SparkSession, d: str) -> DataFrame:
    """Direct keys and two kinds of alternates; the first kind wins, direct keys before all."""
    c = table(spark, d, "corpus")
    flat = c.where(F.col("url").contains("/tin/")).select(F.col("url").alias("corpus_url"), U.flat_address("url", "mirror.example").alias("archived_url"), F.lit(1).alias("prio"))
    short = c.select(F.col("url").alias("corpus_url"), F.concat(F.lit("http://"), U.hostname("url"), F.lit("/"), U.first_segment("url")).alias("archived_url"), F.lit(2).alias("prio"))
    return C.wanted_keys(c, flat.unionByName(short)).select("key", "id", "prio")


def record_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Pages not held yet with their five newest records of a usable size."""
    have = store.done_ids(table(spark, d, "pages").select("id", "kind"), store.ARCHIVE_HAVE, None)
    want = _wanted(spark, d).join(have, "id", "left_anti").select("key", "id")
    recs = C.usable_records(table(spark, d, "cc_index")).withColumn("key", U.canonical("url"))
    rows = recs.join(want, "key").select("id", "ts", "filename", "offset", "length")
    return C.newest(rows, 5, order=("ts", "filename", "offset", "length")).select("id", "rank", "ts", "filename", "offset", "length")


def capture_best(spark: SparkSession, d: str) -> DataFrame:
    """First candidate of each wanted page that is accepted: a record of over 2,000 bytes."""
    return C.first_accepted(record_candidates(spark, d), F.col("length") > 2000).select("id", "accepted", "rank", "ts", "filename")


def archive_counts(spark: SparkSession, d: str) -> DataFrame:
    """Corpus and archived pages side by side per host."""
    found = _matches(spark, d).select("id").distinct().withColumn("hit", F.lit(1))
    c = table(spark, d, "corpus").select("id", U.host_key("url").alias("host"))
    return c.join(found, "id", "left").groupBy("host").agg(F.count("*").alias("n_corpus"), F.count("hit").alias("n_archived"))


def _surts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cc_index").select(U.surt(U.hostname("url"), F.regexp_replace(U.url_path("url"), "^/", "")).alias("key")).distinct()


def _prefixes(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "corpus").select(U.hostname("url").alias("host"), U.first_segment("url").alias("segment"))
    big = c.where("segment <> ''").groupBy("host", "segment").agg(F.count("*").alias("n")).where("n >= 5")
    return big.select(U.surt("host", F.concat("segment", F.lit("/"))).alias("prefix")).distinct()


def prefix_segments(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "corpus").select(U.hostname("url").alias("host"), U.first_segment("url").alias("segment"))
    return reports.prefix_plan(c, "host", "segment", min_urls=5)


def block_overlap(spark: SparkSession, d: str) -> DataFrame:
    return R.overlapping(R.blocks(_surts(spark, d)), _prefixes(spark, d))


def predecessor_block(spark: SparkSession, d: str) -> DataFrame:
    probes = _prefixes(spark, d).select(F.col("prefix").alias("probe"))
    return R.predecessor(R.blocks(_surts(spark, d)), probes)


def not_returned_anti(spark: SparkSession, d: str) -> DataFrame:
    """Wanted pages for which neither index returned anything, in batches of 200."""
    from ..operators.windows import batches

    c = table(spark, d, "corpus").select("id", U.canonical("url").alias("key"))
    cdx = table(spark, d, "cdx").select(U.canonical("original").alias("key"))
    cc = table(spark, d, "cc_index").select(U.canonical("url").alias("key"))
    gone = c.join(cdx, "key", "left_anti").join(cc, "key", "left_anti").withColumn("cell", F.floor(F.col("id") / 100_000))
    return batches(gone, ("id",), 200, ("cell",)).select("id", "cell", "batch")


def unmapped_validation(spark: SparkSession, d: str) -> DataFrame:
    """Archive rows whose address is not the one the wanted list maps to: missing counts as different."""
    p = table(spark, d, "pages").where("source = 'db_wayback' and kind = 'ok'").select("id", U.canonical(U.unwrapped("final_url")).alias("got"))
    w = _wanted(spark, d).where("prio = 0").select("id", F.col("key").alias("expected"))
    j = p.join(w, "id", "left")
    return j.groupBy("id").agg(F.max(~F.coalesce("got", F.lit("")).eqNullSafe(F.coalesce("expected", F.lit("")))).alias("bad"))


def slug_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Per section: pages, and pages whose archived address is found by their number; the later path wins."""
    num = lambda c: F.regexp_extract(c, r"(\d{5,})", 1)
    arch = table(spark, d, "cdx").select(num(U.url_path("original")).alias("n"), U.url_path("original").alias("p")).where("n <> ''").groupBy("n").agg(F.max("p").alias("p"))
    c = table(spark, d, "corpus").select("id", F.split_part(U.url_path("url"), F.lit("/"), F.lit(2)).alias("section"), num(U.url_path("url")).alias("n"))
    return c.join(arch, "n", "left").groupBy("section").agg(F.count("*").alias("n_pages"), F.count("p").alias("n_mapped"))


def mime_filter(spark: SparkSession, d: str) -> DataFrame:
    """Index lines parsed from their JSON tail, kept with status 200 and a detected or declared HTML type."""
    js = F.to_json(F.struct(F.col("url"), F.when(F.col("offset") % 7 == 0, "404").otherwise("200").alias("status"),
                            F.when(F.col("offset") % 3 == 0, "").otherwise("text/html").alias("mime-detected"),
                            F.when(F.col("offset") % 2 == 0, "text/html").otherwise("image/png").alias("mime")))
    line = F.concat_ws(" ", U.surt(U.hostname("url")), "ts", js)
    parts = F.split(F.col("line"), " ", 3)
    schema = "url string, status string, `mime-detected` string, mime string"
    rec = table(spark, d, "cc_index").select(line.alias("line")).select(parts[0].alias("key"), parts[1].alias("ts"), F.from_json(parts[2], schema).alias("r"))
    mime = F.coalesce(F.nullif(F.col("r.mime-detected"), F.lit("")), F.nullif(F.col("r.mime"), F.lit("")), F.lit(""))
    return rec.where((F.col("r.status") == "200") & mime.contains("html")).groupBy("key").agg(F.count("*").alias("n"), F.max("ts").alias("newest"))


QUERIES = {
    f.__name__: f
    for f in (
        capture_match, capture_newest_k, capture_cutoff, key_priority_union, record_candidates, capture_best, archive_counts, prefix_segments, block_overlap,
        predecessor_block, not_returned_anti, unmapped_validation, slug_mapping, mime_filter,
    )
}

_CUT = f"NOT ({Q.hostname('original')} IN {CUT_HOSTS} AND ts >= '{CUTOFF}')"
_WANT = f"(SELECT {Q.canonical('url')} AS key, max(id) AS id FROM corpus GROUP BY 1)"
_MATCH = f"(SELECT w.id, c.ts, c.original FROM (SELECT *, {Q.canonical('original')} AS key FROM cdx WHERE {_CUT}) c JOIN {_WANT} w USING (key))"
_CAND = f"""SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY ts DESC, filename DESC, "offset" DESC, length DESC) AS INT) AS rank, ts, filename, "offset", length
    FROM (SELECT DISTINCT w.id, ts, filename, "offset", length FROM (SELECT *, {Q.canonical('url')} AS key FROM cc_index WHERE length >= 1500) c
    JOIN {_WANT} w USING (key) WHERE w.id NOT IN (SELECT id FROM pages WHERE kind IN ('ok','notfound','home'))) QUALIFY rank <= 5"""
_SURTS = f"(SELECT DISTINCT {Q.surt(Q.hostname('url'))} || regexp_replace({Q.path('url')}, '^/', '') AS key FROM cc_index)"
_BLOCKS = f"""(SELECT n // 10 AS block, key AS first_key, coalesce(lead(key) OVER (ORDER BY n), chr(65535)) AS next_key
    FROM (SELECT key, row_number() OVER (ORDER BY encode(key)) - 1 AS n FROM {_SURTS}) WHERE n % 10 = 0)"""
_SEG = f"(SELECT {Q.hostname('url')} AS host, {Q.segment('url')} AS segment, count(*) AS n FROM corpus GROUP BY 1, 2)"
_PREF = f"(SELECT DISTINCT {Q.surt('host')} || segment || '/' AS prefix FROM {_SEG} WHERE segment <> '' AND n >= 5)"
_NUM = "regexp_extract({}, '(\\d{{5,}})', 1)"
SQL = {
    "capture_match": f"SELECT id, count(*) AS n_captures, min(ts) AS oldest, max(ts) AS newest FROM {_MATCH} GROUP BY id",
    "capture_newest_k": f"""SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY ts DESC, original DESC) AS INT) AS rank, ts, original
        FROM (SELECT DISTINCT * FROM {_MATCH}) QUALIFY rank <= 3""",
    "capture_cutoff": f"SELECT {Q.hostname('original')} AS host, count(*) AS n, max(ts) AS newest FROM cdx WHERE {_CUT} GROUP BY 1",
    "key_priority_union": f"""WITH k AS (
        SELECT {Q.canonical('url')} AS key, id, 0 AS prio, -id AS r FROM corpus
        UNION ALL SELECT {Q.canonical("u")}, id, 1, id FROM (SELECT id, 'https://mirror.example/' || regexp_replace({Q.path('url')}, '^/+|/+$', '', 'g') || '.htm' AS u FROM corpus WHERE contains(url, '/tin/'))
        UNION ALL SELECT {Q.canonical("u")}, id, 2, id FROM (SELECT id, 'http://' || {Q.hostname('url')} || '/' || {Q.segment('url')} AS u FROM corpus))
        SELECT key, id, prio FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY prio, r) = 1""",
    "record_candidates": _CAND,
    "capture_best": f"""WITH c AS ({_CAND}), b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rank) AS n FROM c WHERE length > 2000)
        SELECT i.id, b.id IS NOT NULL AS accepted, b.rank, b.ts, b.filename FROM (SELECT DISTINCT id FROM c) i LEFT JOIN (SELECT * FROM b WHERE n = 1) b USING (id)""",
    "archive_counts": f"""SELECT {Q.host_key('url')} AS host, count(*) AS n_corpus, count(m.id) AS n_archived FROM corpus c LEFT JOIN (SELECT DISTINCT id FROM {_MATCH}) m USING (id) GROUP BY 1""",
    "prefix_segments": f"""SELECT host, CAST(sum(n) AS BIGINT) AS n_urls, CAST(coalesce(sum(n) FILTER (WHERE segment <> '' AND n >= 5), 0) AS BIGINT) AS n_covered,
        count(*) FILTER (WHERE segment <> '' AND n >= 5) AS n_prefixes, coalesce(sum(n) FILTER (WHERE segment <> '' AND n >= 5), 0) >= 0.95 * sum(n) AS by_prefix FROM {_SEG} GROUP BY host""",
    "block_overlap": f"SELECT * FROM {_BLOCKS} b WHERE EXISTS (SELECT 1 FROM {_PREF} p WHERE encode(b.first_key) < encode(p.prefix || chr(65535)) AND encode(b.next_key) > encode(p.prefix))",
    "predecessor_block": f"SELECT p.prefix AS probe, max(b.block) AS block FROM {_PREF} p LEFT JOIN {_BLOCKS} b ON encode(b.first_key) <= encode(p.prefix) GROUP BY 1",
    "not_returned_anti": f"""SELECT id, id // 100000 AS cell, (row_number() OVER (PARTITION BY id // 100000 ORDER BY id) - 1) // 200 AS batch FROM (SELECT id, {Q.canonical('url')} AS key FROM corpus)
        WHERE key NOT IN (SELECT {Q.canonical('original')} FROM cdx) AND key NOT IN (SELECT {Q.canonical('url')} FROM cc_index)""",
    "unmapped_validation": f"""SELECT p.id, max(coalesce(p.got, '') <> coalesce(w.key, '')) AS bad FROM
        (SELECT id, {Q.canonical(Q.unwrapped('final_url'))} AS got FROM pages WHERE source = 'db_wayback' AND kind = 'ok') p LEFT JOIN {_WANT} w USING (id) GROUP BY p.id""",
    "slug_mapping": f"""WITH a AS (SELECT {_NUM.format(Q.path('original'))} AS n, max({Q.path('original')}) AS p FROM cdx GROUP BY 1 HAVING n <> '')
        SELECT split_part({Q.path('url')}, '/', 2) AS section, count(*) AS n_pages, count(a.p) AS n_mapped FROM corpus c LEFT JOIN a ON a.n = {_NUM.format(Q.path('c.url'))} GROUP BY 1""",
    "mime_filter": f"""SELECT {Q.surt(Q.hostname('url'))} AS key, count(*) AS n, max(ts) AS newest FROM cc_index
        WHERE "offset" % 7 <> 0 AND ("offset" % 3 <> 0 OR "offset" % 2 = 0) GROUP BY 1""",
}
