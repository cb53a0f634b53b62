"""Queries over sources, sinks and streams; whole tables make the round trips."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..session import shared_dir, ship, table
from ..sources import files, records
from ..streaming import replay
from .reports_q import epoch_seconds


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/io/{name}-{uuid.uuid4().hex}"


def _local(path: str) -> str:
    """A shared folder as a path of the file system the nodes mount."""
    return path[len("file://") :] if path.startswith("file://") else path.removeprefix("file:")


def tsv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Captures written and read as headerless TSV; the file's stem names the index."""
    path = _place(spark, "cdx")
    files.write_tsv(table(spark, d, "cdx").select("ts", "original"), path)
    back = files.read_tsv(spark, path, files.CAPTURES, "index_file")
    return back.groupBy("ts", "original").agg(F.count("*").alias("n"))


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "coverage")
    files.write_csv(table(spark, d, "coverage").select("host", "total", "stored", "dead", "robots", "queued_archive", "no_source", "queued_direct"), path, one_file=True)
    return files.read_csv(spark, path, files.COVERAGE).groupBy("host", "total", "stored").agg(F.count("*").alias("n"))


def jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "cc")
    files.write_jsonl(table(spark, d, "cc_index"), path)
    return files.read_jsonl(spark, path, files.RECORDS).groupBy("host").agg(F.count("*").alias("n"), F.sum("length").alias("n_bytes"), F.count("length").alias("n_known"))


def partitioned_store(spark: SparkSession, d: str) -> DataFrame:
    """Page store written by source and host and read with both predicates pruning partitions."""
    path = _place(spark, "store")
    cols = ["source", "host", "id", "kind", "nbytes", "html"]
    p = table(spark, d, "pages").select(*cols).withColumn("host", F.lower(F.regexp_replace("host", "[^A-Za-z0-9.-]", "_")))
    p.write.option("compression", "zstd").partitionBy("source").parquet(path)
    back = spark.read.parquet(path).where("source = 'db_wayback' and kind = 'ok'")
    return back.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.octet_length("html")).cast("long").alias("n_html"))


def index_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Sorted index lines written as gzip text and parsed again."""
    path = _place(spark, "blocks")
    js = F.to_json(F.struct(F.col("url"), F.lit("200").alias("status"), F.lit("text/html").alias("mime"), F.col("filename"), F.col("offset").cast("string").alias("offset"), F.col("length").cast("string").alias("length")))
    line = F.concat_ws(" ", U.surt(U.hostname("url")), "ts", js)
    table(spark, d, "cc_index").select(line.alias("value")).write.option("compression", "gzip").text(path)
    return files.read_index_blocks(spark, path).groupBy("key").agg(F.count("*").alias("n"), F.sum("length").alias("n_bytes"), F.max("ts").alias("newest"))


def warc_parse(spark: SparkSession, d: str) -> DataFrame:
    """Every stored body wrapped into a compressed record and parsed out of it again."""
    ship(spark)

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [
                gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\nServer: x\r\nContent-Type: " + (c or "").encode("latin-1", "replace") + b"\r\n\r\n" + h, 1)
                for c, h in zip(b.column(2).to_pylist(), b.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(raw, pa.binary())], names=["source", "id", "raw"])

    p = table(spark, d, "pages").where("html is not null").select("source", "id", "ctype", F.col("html").cast("binary").alias("html"))
    parsed = records.parse_records(p.mapInArrow(wrap, "source string, id long, raw binary"), "raw", "source", "id")
    return parsed.groupBy("source", "ctype").agg(F.count("*").alias("n"), F.sum(F.octet_length("body")).cast("long").alias("n_bytes"))


def xml_slice(spark: SparkSession, d: str) -> DataFrame:
    """Batches of 20 records as one text, sliced into records again; records asked for and not returned stay out."""
    rec = F.concat(F.lit('<PubmedArticle><PMID Version="1">'), F.col("id").cast("string"), F.lit("</PMID><T>"), U.hostname("url"), F.lit("</T></PubmedArticle>"))
    c = table(spark, d, "corpus").select(F.floor(F.col("id") / 20).cast("long").alias("batch"), F.when(F.col("id") % 10 != 3, rec).alias("r"))
    text = c.groupBy("batch").agg(F.concat_ws("\n", F.collect_list("r")).alias("t"))
    return text.select("batch", F.explode(records.xml_records(F.col("t"))).alias("x")).select("batch", F.col("x.number").alias("number"), F.length("x.record").cast("long").alias("n_chars"))


def index_parse(spark: SparkSession, d: str) -> DataFrame:
    """Catalog pages built from the corpus and parsed into entries: chapters, headings of groups before a chapter, whole-book
    and fragment links, and entries without any link."""
    i = F.col("id")
    number = i.cast("string")
    own = F.concat(F.lit('<a class="c" href="/c/'), number, F.lit('.html">x</a>'))
    link = (
        F.when(i % 7 == 0, F.concat(F.lit('<a href="/g/'), number, F.lit('.html" class="catalog_group">g</a>'), own))
        .when(i % 7 == 1, F.concat(F.lit('<a href="/quanben'), number, F.lit('.html">all</a>'), own))
        .when(i % 7 == 2, F.concat(F.lit('<a href="/c/'), number, F.lit('.html#top">x</a><b>'), own, F.lit("</b>")))
        .when(i % 7 == 3, F.lit("no link"))
        .when(i % 7 == 4, F.concat(F.lit('<a href="/c/'), number, F.lit('_group.html">x</a>')))
        .otherwise(own)
    )
    li = F.concat(F.lit('<li id="si'), number, F.lit('">'), link)
    books = table(spark, d, "corpus").select(F.floor(i / 50).cast("long").alias("book"), "id", li.alias("li")).groupBy("book").agg(
        F.concat(F.lit('<ul id="catalog-content">'), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "li"))), lambda x: x.li), ""), F.lit("</ul>")).alias("html")
    )
    return records.catalog_entries(books, "html", "book").select("book", "si", "href")


def status_explode(spark: SparkSession, d: str) -> DataFrame:
    """A status document of all hosts, written as nested JSON and exploded again."""
    path = _place(spark, "status")
    g = table(spark, d, "pages").groupBy("host").agg(
        F.count("*").alias("queue"), F.max("attempts").alias("strikes"), F.max(F.col("kind") == "captcha").alias("disabled"), F.sum(F.when(F.col("kind") == "blocked", 60).otherwise(0)).alias("paused_for")
    )
    one = F.struct(
        F.col("queue"), F.lit(2.0).alias("rate"), "disabled", "strikes", "paused_for", F.when(F.col("disabled"), F.array("host")).otherwise(F.array().cast("array<string>")).alias("dead_hosts")
    )
    # one document per host: a document of all hosts would be one row of unbounded size
    doc = g.select(F.lit("2024-01-01 00:00:00").alias("updated"), F.lit(1.5).alias("elapsed_min"), F.create_map("host", one).alias("groups"))
    doc.write.json(path)
    s = files.status_groups(spark.read.schema(files.STATUS).json(path))
    return s.where("shown").select("name", "queue", "disabled", "strikes", "paused_for", F.size("dead_hosts").alias("n_dead"))


#: Files of one micro-batch, which bounds what a group holds at once.
FILES_PER_TRIGGER = 8


def _events_stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    schema = table(spark, d, name).schema
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{d}/{name}.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_TRIGGER)
    if fs.getFileStatus(path).isDirectory():
        return reader.parquet(f"{d}/{name}.parquet")
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(d)


def _drain(stream: DataFrame, spark: SparkSession, name: str, mode: str) -> DataFrame:
    """All output of a stream over what is there, with the number of its micro-batch."""
    path = _place(spark, name)

    def sink(df: DataFrame, batch: int) -> None:
        df.withColumn("batch", F.lit(batch).cast("long")).write.mode("append").parquet(path)

    q = stream.writeStream.foreachBatch(sink).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", path + "-checkpoint").start()
    q.awaitTermination()
    return spark.read.parquet(path)


def minute_stream(spark: SparkSession, d: str) -> DataFrame:
    out = _drain(replay.minute_counts(_events_stream(spark, d, "events")), spark, "minutes", "update")
    return out.groupBy(epoch_seconds("minute").alias("minute"), F.col("kind").alias("event_type")).agg(F.max("n").alias("n"))


def run_counters(spark: SparkSession, d: str) -> DataFrame:
    out = _drain(replay.running_counts(_events_stream(spark, d, "events"), "user_id", "event_type"), spark, "counters", "update")
    return out.groupBy("user_id", "event_type").agg(F.max("n").alias("n"))


def limiter_replay(spark: SparkSession, d: str) -> DataFrame:
    """Final limiter state of every host over the fetch log."""
    log = _events_stream(spark, d, "pages").select("host", "fetched_at", "kind")
    return _last_states(_drain(replay.limiter_states(log), spark, "limiter", "update"), replay.Limiter)


def throttle_replay(spark: SparkSession, d: str) -> DataFrame:
    """Final archive throttle state of every source over the fetch log; every third page counts as refused."""
    log = _events_stream(spark, d, "pages").select("source", "fetched_at", F.when(F.col("id") % 3 == 0, "blocked").otherwise(F.col("kind")).alias("kind"))
    return _last_states(_drain(replay.throttle_states(log), spark, "throttle", "update"), replay.Throttle)


def _last_states(out: DataFrame, machine: type) -> DataFrame:
    return out.groupBy("grp").agg(F.max_by(F.struct(*machine._fields), "batch").alias("s")).select("grp", "s.*")


QUERIES = {
    f.__name__: f
    for f in (
        tsv_roundtrip, csv_roundtrip, jsonl_roundtrip, partitioned_store, index_blocks, warc_parse, xml_slice, index_parse, status_explode, minute_stream,
        run_counters, limiter_replay, throttle_replay,
    )
}
from . import sqlparts as Q  # noqa: E402

# A row after the other by recursion: what the folds over runs must come to.
_LIMITER = f"""WITH RECURSIVE e AS (SELECT host AS grp, fetched_at AS t, kind IN ('blocked', 'captcha') AS b, kind = 'error' AS x,
        row_number() OVER (PARTITION BY host ORDER BY fetched_at, kind) AS rn FROM pages),
    s AS (SELECT DISTINCT grp, 0::BIGINT AS rn, 0 AS strikes, 0.0::DOUBLE AS paused_until, 0 AS ok_streak, 0.5::DOUBLE AS iv, false AS disabled, 0 AS errors, false AS dead FROM e
    UNION ALL SELECT grp, rn, CASE WHEN hit AND strikes < 8 THEN strikes + 1 WHEN b OR x THEN strikes ELSE 0 END,
        CASE WHEN hit AND strikes < 8 THEN t + {list(replay.BLOCK_PAUSES)}[strikes + 1] ELSE paused_until END,
        CASE WHEN hit AND strikes < 8 THEN 0 WHEN b OR x THEN ok_streak WHEN ok_streak >= 499 AND iv > 0.5 THEN 0 ELSE ok_streak + 1 END,
        CASE WHEN hit AND strikes < 8 THEN least(iv * 1.5, 5.0) WHEN NOT (b OR x) AND ok_streak >= 499 AND iv > 0.5 THEN greatest(0.5, iv / 1.1) ELSE iv END,
        disabled OR (hit AND strikes >= 8), CASE WHEN x THEN errors + 1 WHEN b THEN errors ELSE 0 END, dead OR (x AND errors >= 59)
        FROM (SELECT e.grp, e.rn, e.t, e.b, e.x, s.strikes, s.paused_until, s.ok_streak, s.iv, s.disabled, s.errors, s.dead, e.b AND e.t >= s.paused_until AS hit
            FROM s JOIN e ON e.grp = s.grp AND e.rn = s.rn + 1))
    SELECT grp, strikes, paused_until, ok_streak, iv AS "interval", disabled, errors, dead FROM s QUALIFY row_number() OVER (PARTITION BY grp ORDER BY rn DESC) = 1"""
_THROTTLE = f"""WITH RECURSIVE e AS (SELECT source AS grp, fetched_at AS t, id % 3 = 0 OR kind IN ('blocked', 'captcha') AS b, id % 3 <> 0 AND kind = 'error' AS x,
        row_number() OVER (PARTITION BY source ORDER BY fetched_at, CASE WHEN id % 3 = 0 THEN 'blocked' ELSE kind END) AS rn FROM pages),
    s AS (SELECT DISTINCT grp, 0::BIGINT AS rn, 0 AS level, 0.0::DOUBLE AS paused_until, 0 AS ok_streak, 0.25::DOUBLE AS rate FROM e
    UNION ALL SELECT grp, rn, CASE WHEN hit THEN level + 1 WHEN b OR x THEN level ELSE 0 END,
        CASE WHEN hit THEN t + {list(replay.THROTTLE_PAUSES)}[least(level, 3) + 1] ELSE paused_until END,
        CASE WHEN hit THEN 0 WHEN b OR x THEN ok_streak WHEN ok_streak >= 299 AND rate < 0.5 THEN 0 ELSE ok_streak + 1 END,
        CASE WHEN hit THEN greatest(0.1, rate / 2) WHEN NOT (b OR x) AND ok_streak >= 299 AND rate < 0.5 THEN least(0.5, rate * 1.1) ELSE rate END
        FROM (SELECT e.grp, e.rn, e.t, e.b, e.x, s.level, s.paused_until, s.ok_streak, s.rate, e.b AND e.t >= s.paused_until AS hit
            FROM s JOIN e ON e.grp = s.grp AND e.rn = s.rn + 1))
    SELECT grp, level, paused_until, ok_streak, rate FROM s QUALIFY row_number() OVER (PARTITION BY grp ORDER BY rn DESC) = 1"""
SQL = {
    "tsv_roundtrip": "SELECT ts, original, count(*) AS n FROM cdx GROUP BY 1, 2",
    "csv_roundtrip": "SELECT host, total, stored, count(*) AS n FROM coverage GROUP BY 1, 2, 3",
    "jsonl_roundtrip": "SELECT host, count(*) AS n, CAST(sum(length) AS BIGINT) AS n_bytes, count(length) AS n_known FROM cc_index GROUP BY 1",
    "partitioned_store": """SELECT lower(regexp_replace(host, '[^A-Za-z0-9.-]', '_', 'g')) AS host, count(*) AS n, CAST(sum(octet_length(html)) AS BIGINT) AS n_html
        FROM pages WHERE source = 'db_wayback' AND kind = 'ok' GROUP BY 1""",
    "index_blocks": f"SELECT {Q.surt(Q.hostname('url'))} AS key, count(*) AS n, CAST(sum(length) AS BIGINT) AS n_bytes, max(ts) AS newest FROM cc_index GROUP BY 1",
    "warc_parse": "SELECT source, trim(coalesce(ctype, '')) AS ctype, count(*) AS n, CAST(sum(octet_length(html)) AS BIGINT) AS n_bytes FROM pages WHERE html IS NOT NULL GROUP BY 1, 2",
    "xml_slice": f"""SELECT id // 20 AS batch, CAST(id AS VARCHAR) AS number,
        CAST(length('<PubmedArticle><PMID Version="1">' || id || '</PMID><T>' || {Q.hostname('url')} || '</T></PubmedArticle>') AS BIGINT) AS n_chars FROM corpus WHERE id % 10 <> 3""",
    "index_parse": "SELECT id // 50 AS book, id AS si, CASE WHEN id % 7 IN (0, 2, 5, 6) THEN '/c/' || id || '.html' END AS href FROM corpus",
    "status_explode": """SELECT host AS name, count(*) AS queue, max(kind = 'captcha') AS disabled, max(attempts) AS strikes,
        CAST(sum(CASE WHEN kind = 'blocked' THEN 60 ELSE 0 END) AS BIGINT) AS paused_for, CAST(max(kind = 'captcha') AS INT) AS n_dead FROM pages GROUP BY host""",
    "minute_stream": "SELECT CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS minute, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "limiter_replay": _LIMITER,
    "throttle_replay": _THROTTLE,
    "run_counters": "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
