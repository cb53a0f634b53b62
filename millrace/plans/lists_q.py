"""Queries over work lists, labels, formats, listings and text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import formats as T
from ..functions import urls as U
from ..operators import reports as R
from ..operators import windows as W
from ..session import stage, table
from ..sources import files, records
from ..streaming import replay
from . import sqlparts as Q
from .io_q import _place
from .reports_q import _LOG, _MISS, _RED, _moved, _states, missing_export

#: What a report calls each reason (configuration of these queries).
LABELS = {
    "no_source": "no copy anywhere", "no_source_book_rejected": "the book could not be aligned", "no_source_not_archived": "mapped, but not archived",
    "dead": "gone at the origin", "robots": "disallowed by robots.txt",
}
#: Lookup targets: a domain stands for all hosts below it, a host for itself.
GROUPS = ("test", "invalid", "suckhoe.example")


def _draw() -> Column:
    """Pseudo-random order that any engine can repeat."""
    return (F.col("id") * 7919) % 1009


def crawl_order(spark: SparkSession, d: str) -> DataFrame:
    """The pending list in seeded order, the largest host's pages behind all others, cut to 5,000 in all."""
    c = table(spark, d, "corpus").select("id", U.host_key("url").alias("host"))
    counts = c.groupBy("host").agg(F.count("*").alias("n"))
    largest = counts.agg(F.max_by("host", F.struct("n", "host")).alias("_large"))  # one row
    rows = c.join(F.broadcast(largest))
    return W.shuffled(rows, _draw(), F.col("host") == F.col("_large"), limit=5000).select("place", "id", "host")


def group_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Lookup targets expanded into the hosts of the list: the hosts below a domain, or the host itself."""
    hosts = table(spark, d, "corpus").select(U.hostname("url").alias("host")).distinct()
    # every suffix of a host is looked up, so no host meets every target
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."))
    targets = spark.createDataFrame([(g,) for g in GROUPS], "target string")
    return hosts.select("host", F.explode(suffixes).alias("target")).join(F.broadcast(targets), "target").groupBy("target").agg(F.count("*").alias("n_hosts"), F.min("host").alias("first_host"))


def catalog_work(spark: SparkSession, d: str) -> DataFrame:
    """Catalogs still to fetch, books with most pages first: those of every third book are there already."""
    books = table(spark, d, "corpus").select(U.site("url").alias("book"), U.first_segment("url").alias("section")).groupBy("book", "section").agg(F.count("*").alias("n"))
    cached = books.where(F.length("book") % 3 == 0).select("book", "section")
    todo = books.join(cached, ["book", "section"], "left_anti").withColumn("_down", -F.col("n"))
    return W.batches(todo, ("_down", "book", "section"), 1).select(F.col("batch").alias("place"), "book", "section", "n")


def paced_slots(spark: SparkSession, d: str) -> DataFrame:
    """When each fetch of the log could have started at two a second per host."""
    p = table(spark, d, "pages").select("host", "source", "id", (F.floor(F.floor("fetched_at") / 600) * 600.0).alias("at"), "attempts", "kind").distinct()
    out = W.paced(p, ("host",), "at", ("source", "id", "attempts", "kind"), 0.5)
    return out.groupBy("host").agg(F.count("*").alias("n"), F.round(F.max("slot") - F.min("at"), 3).alias("span"), F.round(F.max(F.col("slot") - F.col("at")), 3).alias("longest_wait"))


def backoff_waits(spark: SparkSession, d: str) -> DataFrame:
    """Seconds every client waits after each attempt."""
    n = F.col("attempts")
    rows = table(spark, d, "pages").select("attempts").distinct()
    return rows.select("attempts", *[rule(n).alias(name) for name, rule in replay.BACKOFF.items()])


def reason_labels(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "missing").groupBy("reason").agg(F.count("*").alias("n"))
    return m.select("reason", T.labelled(F.col("reason"), LABELS).alias("label"), T.grouped(F.col("n") * 1000).alias("n"))


def size_texts(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").groupBy("host").agg(F.sum("nbytes").alias("b"))
    return p.select("host", T.grouped(F.col("b")).alias("n_bytes"), T.size_text(F.col("b") - F.col("b") % (1 << 18)).alias("mb"), T.size_text((F.col("b") - F.col("b") % (1 << 18)) * 4096).alias("gb"))


def time_texts(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").groupBy("host").agg(F.max("fetched_at").alias("t"))
    return p.select("host", T.time_text(F.col("t")).alias("updated"), T.time_text(F.col("t"), "yyyy-MM-dd HH:mm:ss").alias("precise"))


def redirect_order(spark: SparkSession, d: str) -> DataFrame:
    """The redirect table in the report's order."""
    return R.sorted_redirects(R.redirected(_moved(spark, d)))


def markdown_lines(spark: SparkSession, d: str) -> DataFrame:
    """The missing-page report, line by line, by section."""
    states = stage(_states(spark, d), "states")
    counts = states.groupBy("state").agg(F.count("*").alias("n"))
    missing = stage(missing_export(spark, d), "missing")
    return files.markdown_report(counts, missing, redirect_order(spark, d), LABELS).select("section", "line")


def line_counts(spark: SparkSession, d: str) -> DataFrame:
    """Index lines written as text, a folder per host, and counted by folder."""
    path = _place(spark, "lines")
    t = table(spark, d, "cc_index").select(F.coalesce(F.col("host"), F.lit("none")).alias("host"), F.concat_ws(" ", "ts", "filename").alias("value"))
    t.write.partitionBy("host").text(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/host=([^/]*)/", 1)  # the folder escapes the host, its path the folder
    back = spark.read.text(path + "/*/").select(F.url_decode(F.url_decode(name)).alias("host"))
    return back.groupBy("host").agg(F.count("*").alias("n"))


def lenient_text(spark: SparkSession, d: str) -> DataFrame:
    """Text files read whole, bytes that are no UTF-8 dropped, and split into lines again."""
    path = _place(spark, "text")
    table(spark, d, "corpus").select(F.concat_ws("\t", F.col("id").cast("string"), U.site("url")).alias("value")).write.text(path)
    lines = files.read_lenient_text(spark, path + "/*.txt").select(F.explode(F.split("text", "\n")).alias("l")).where("l <> ''")
    return lines.groupBy(F.split_part("l", F.lit("\t"), F.lit(2)).alias("host")).agg(F.count("*").alias("n"), F.max(F.split_part("l", F.lit("\t"), F.lit(1)).cast("long")).alias("last_id"))


def listing_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Files written, one per source, found by a listing with sizes."""
    path = _place(spark, "listing")
    p = table(spark, d, "pages").groupBy("source").agg(F.count("*").alias("n"))
    p.select("source", F.lpad("source", 20, "x").alias("value")).repartition(1).write.partitionBy("source").text(path)
    found = files.read_listing(spark, path, "*.txt")
    return found.select(F.regexp_extract("path", r"/source=([^/]*)/", 1).alias("source"), F.col("length").cast("long").alias("length"))


def robots_rules(spark: SparkSession, d: str) -> DataFrame:
    """Robots texts per host: one section is disallowed and hosts of even length ask for a delay; every fifth address has no rules."""
    host = U.hostname("url")
    c = table(spark, d, "corpus").where(F.col("url").rlike(r"^https?://[a-z0-9.-]+/[A-Za-z0-9/_.-]*$"))
    text = F.when(F.col("id") % 5 != 0, F.concat(F.lit("User-agent: *\nDisallow: /tin/\n"), F.when(F.length(host) % 2 == 0, F.lit("Crawl-delay: 7\n")).otherwise(F.lit(""))))
    return records.robots_rules(c.select("id", "url", text.alias("rules")), "rules", "url").select("id", "allowed", "crawl_delay")


def collection_list(spark: SparkSession, d: str) -> DataFrame:
    """Names of a JSON list that follow the naming rule, one list per host."""
    name = F.concat(F.when(F.col("offset") % 3 == 0, "CRAWL-").otherwise("OTHER-"), F.substring("ts", 1, 4), F.lit("-"), F.substring("ts", 5, 2))
    rows = table(spark, d, "cc_index").select(F.coalesce("host", F.lit("none")).alias("host"), name.alias("id")).distinct()
    docs = rows.groupBy("host").agg(F.to_json(F.array_sort(F.collect_list(F.struct("id")))).alias("doc"))  # a host has at most the months there are
    return docs.select("host", F.explode(records.collections(F.col("doc"), r"CRAWL-\d{4}-\d{2}")).alias("name"))


def listing_parse(spark: SparkSession, d: str) -> DataFrame:
    """Listings as text, a page of captures per host and month, parsed into captures; lines without a blank drop out."""
    c = table(spark, d, "cdx").select(U.hostname("original").alias("host"), F.substring("ts", 1, 6).alias("month"), F.when(F.length("ts") % 2 == 0, F.concat_ws(" ", "ts", "original")).otherwise(F.concat("ts", F.lit("-"))).alias("l"))
    pages = c.groupBy("host", "month").agg(F.array_join(F.collect_list("l"), "\r\n").alias("page"))
    caps = pages.select("host", F.explode(records.listing_lines(F.col("page"))).alias("x"))
    return caps.groupBy("host", "x.ts").agg(F.count("*").alias("n"), F.min("x.original").alias("first"))


def status_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Counters of a status document per host, written as nested JSON and exploded again."""
    path = _place(spark, "status")
    per = table(spark, d, "pages").groupBy("host", "kind").agg(F.count("*").alias("n"))
    doc = per.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("kind", "n"))).alias("c")).select(F.lit("t").alias("updated"), F.lit(1.0).alias("elapsed_min"), F.create_map("host", "c").alias("hosts"))
    doc.write.json(path)
    return files.status_hosts(spark.read.schema(files.STATUS).json(path)).select("host", "kind", "n")


QUERIES = {
    f.__name__: f
    for f in (
        crawl_order, group_hosts, catalog_work, paced_slots, backoff_waits, reason_labels, size_texts, time_texts, redirect_order, markdown_lines, line_counts, lenient_text,
        listing_sizes, robots_rules, collection_list, listing_parse, status_hosts,
    )
}


def _labels(c: str) -> str:
    return "CASE " + c + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items()) + f" ELSE {c} END"


def _size(b: str) -> str:
    return f"CASE WHEN {b} >= 1073741824 THEN printf('%.2f GB', {b} / 1073741824.0) ELSE printf('%.2f MB', {b} / 1048576.0) END"


_HC = f"(SELECT id, {Q.host_key('url')} AS host FROM corpus)"
_TREE = f"SELECT host, count(*) FILTER (WHERE redirect = 'same_article') AS same_article, count(*) FILTER (WHERE redirect = 'different_article') AS different_article, count(*) FILTER (WHERE redirect = 'non_html') AS non_html FROM {_RED} WHERE redirect IS NOT NULL GROUP BY 1"
_ORDERED = f"SELECT *, row_number() OVER (ORDER BY different_article DESC, non_html DESC, same_article DESC, encode(host)) - 1 AS place FROM ({_TREE})"
from .reports_q import _ST  # noqa: E402

SQL = {
    "crawl_order": f"""WITH c AS {_HC}, big AS (SELECT host FROM c GROUP BY host ORDER BY count(*) DESC, encode(host) DESC LIMIT 1)
        SELECT row_number() OVER (ORDER BY (host = (SELECT host FROM big))::INT, (id * 7919) % 1009, id) - 1 AS place, id, host FROM c QUALIFY place < 5000""",
    "group_hosts": f"""WITH h AS (SELECT DISTINCT {Q.hostname('url')} AS host FROM corpus), t AS (SELECT unnest({list(GROUPS)}) AS target)
        SELECT target, count(*) AS n_hosts, arg_min(host, encode(host)) AS first_host FROM h JOIN t ON host = target OR ends_with(host, '.' || target) GROUP BY 1""",
    "catalog_work": f"""WITH b AS (SELECT {Q.site('url')} AS book, {Q.segment('url')} AS section, count(*) AS n FROM corpus GROUP BY 1, 2)
        SELECT row_number() OVER (ORDER BY n DESC, encode(book), encode(section)) - 1 AS place, book, section, n FROM b WHERE length(book) % 3 <> 0""",
    "paced_slots": """WITH p AS (SELECT DISTINCT host, source, id, floor(floor(fetched_at) / 600) * 600.0 AS t0, attempts, kind FROM pages),
        n AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY t0, source, id, attempts, kind) - 1 AS n FROM p), s AS (SELECT *, max(t0 - n * 0.5) OVER (PARTITION BY host ORDER BY n) + n * 0.5 AS slot FROM n)
        SELECT host, count(*) AS n, round(max(slot) - min(t0), 3) AS span, round(max(slot - t0), 3) AS longest_wait FROM s GROUP BY 1""",
    "backoff_waits": """SELECT DISTINCT attempts, least(300.0, 15 * pow(2.0, attempts)) AS listing, least(120.0, 5 * pow(2.0, least(attempts, 5))) AS "index", (attempts * 10)::DOUBLE AS upload,
        least(60.0, 3 * pow(2.0, attempts)) AS records FROM pages""",
    "reason_labels": f"SELECT reason, {_labels('reason')} AS label, format('{{:,}}', count(*) * 1000) AS n FROM missing GROUP BY reason",
    "size_texts": f"""WITH p AS (SELECT host, CAST(sum(nbytes) AS BIGINT) AS b, CAST(sum(nbytes) - sum(nbytes) % 262144 AS BIGINT) AS r FROM pages GROUP BY 1)
        SELECT host, format('{{:,}}', b) AS n_bytes, {_size('r')} AS mb, {_size('(r * 4096)')} AS gb FROM p""",
    "time_texts": "SELECT host, strftime(to_timestamp(floor(max(fetched_at))) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M') AS updated, strftime(to_timestamp(floor(max(fetched_at))) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS precise FROM pages GROUP BY 1",
    "redirect_order": _ORDERED,
    "markdown_lines": f"""WITH st AS {_ST}, m AS ({_MISS}), h AS (SELECT host, reason, count(*) AS n FROM m GROUP BY 1, 2)
        SELECT '1 states' AS section, '| ' || state || ' | ' || format('{{:,}}', count(*)) || ' |' AS line FROM st GROUP BY state
        UNION ALL SELECT '2 reasons', '| ' || {_labels('reason')} || ' | ' || format('{{:,}}', count(*)) || ' |' FROM m GROUP BY reason
        UNION ALL SELECT '3 hosts', '| ' || host || ' | ' || format('{{:,}}', CAST(sum(n) AS BIGINT)) || ' | ' || {_labels("first(reason ORDER BY n DESC, reason)")} || ' |' FROM h GROUP BY host
        UNION ALL SELECT '4 redirects', '| ' || host || ' | ' || format('{{:,}}', same_article) || ' | ' || format('{{:,}}', different_article) || ' | ' || format('{{:,}}', non_html) || ' |' FROM ({_TREE})
        UNION ALL SELECT '5 pages', id || chr(9) || url FROM m""",
    "line_counts": "SELECT coalesce(host, 'none') AS host, count(*) AS n FROM cc_index GROUP BY 1",
    "lenient_text": f"SELECT {Q.site('url')} AS host, count(*) AS n, max(id) AS last_id FROM corpus GROUP BY 1",
    "listing_sizes": "SELECT DISTINCT source, CAST(21 AS BIGINT) AS length FROM pages",
    "robots_rules": f"""SELECT id, NOT (id % 5 <> 0 AND starts_with({Q.path('url')}, '/tin/')) AS allowed, CASE WHEN id % 5 <> 0 AND length({Q.hostname('url')}) % 2 = 0 THEN 7.0::DOUBLE END AS crawl_delay
        FROM corpus WHERE regexp_full_match(url, 'https?://[a-z0-9.-]+/[A-Za-z0-9/_.-]*')""",
    "collection_list": """SELECT DISTINCT coalesce(host, 'none') AS host, 'CRAWL-' || ts[1:4] || '-' || ts[5:6] AS name FROM cc_index WHERE "offset" % 3 = 0 AND regexp_full_match(ts[1:6], '\\d{6}')""",
    "listing_parse": f"SELECT {Q.hostname('original')} AS host, ts, count(*) AS n, arg_min(original, encode(original)) AS first FROM cdx WHERE length(ts) % 2 = 0 GROUP BY 1, 2",
    "status_hosts": "SELECT host, kind, count(*) AS n FROM pages GROUP BY 1, 2",
}
