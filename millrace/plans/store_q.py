"""Queries that import, write, compact and repair page stores."""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import store as S
from ..operators.captures import wanted_keys
from ..session import ship, stage, table
from ..sources import files
from . import sqlparts as Q
from .captures_q import _WANT
from .io_q import _local, _place
from .pages_q import _NON_HTML, _hex_head

COLUMNS = ["id", "url", "final_url", "status", "kind", "ctype", "nbytes", "fetched_at", "attempts", "err", "html"]


def write_stores(log: DataFrame, root: str) -> None:
    """The log as SQLite files, one per source and input split, bodies as they are; a file of a lost attempt is replaced."""
    ship(log.sparkSession)
    narrow = log.select(F.spark_partition_id().alias("split"), "source", *COLUMNS)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, sqlite3.Connection] = {}
        n = 0
        for b in batches:
            for at in range(0, b.num_rows, 500):
                split, source, *rest = (c.to_pylist() for c in b.slice(at, 500).columns)
                for i, s in enumerate(source):
                    c = open_.get(s)
                    if c is None:
                        os.makedirs(f"{root}/{s}", exist_ok=True)
                        path = f"{root}/{s}/split{split[i]}.sqlite"
                        if os.path.exists(path):
                            os.remove(path)
                        c = open_[s] = sqlite3.connect(path)
                        c.execute(f"CREATE TABLE pages ({', '.join(COLUMNS)})")
                    c.execute(f"INSERT INTO pages VALUES ({','.join('?' * len(COLUMNS))})", [col[i] for col in rest])
                    n += 1
        for c in open_.values():
            c.commit()
            c.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    narrow.mapInArrow(write, "n long").agg(F.sum("n")).collect()  # one row


def _log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").withColumn("html", F.col("html").cast("binary"))


def store_import(spark: SparkSession, d: str) -> DataFrame:
    """The fetch log as SQLite stores with zstd bodies, read back through the data source with source and kind pushed down."""
    from ..sources.sqlite import register

    register(spark)
    root = _local(_place(spark, "stores"))
    write_stores(files.zstd_packed(_log(spark, d).select("source", *COLUMNS), "html"), root)
    back = spark.read.format("sqlite_store").load(root).where(F.col("kind").isin("ok", "home", "notfound") & (F.col("source") != "db_alt"))
    return back.groupBy("source", "kind").agg(
        F.count("*").alias("n"), F.sum("nbytes").alias("n_bytes"), F.max("attempts").alias("attempts"), F.count("html").alias("n_bodies"),
        F.coalesce(F.sum(F.octet_length("html")), F.lit(0)).cast("long").alias("body_bytes"), F.coalesce(F.sum(F.conv(F.substring(F.md5("html"), 1, 8), 16, 10).cast("long")), F.lit(0)).alias("body_sum"),
    )


def zstd_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Every body packed and unpacked again."""
    p = _log(spark, d).select("source", "id", "html")
    back = files.zstd_unpacked(files.zstd_packed(p, "html"), "html")
    return back.groupBy("source").agg(F.count("*").alias("n"), F.count("html").alias("n_bodies"), F.sum(F.conv(F.substring(F.md5("html"), 1, 8), 16, 10).cast("long")).alias("body_sum"))


def store_compact(spark: SparkSession, d: str) -> DataFrame:
    """Upsert to its end: the newest row of each page written as a partitioned store, a second write replacing one source's
    partitions only, and read back."""
    path = _place(spark, "compact")
    newest = stage(S.latest(_log(spark, d).select("source", "host", *COLUMNS)).withColumn("host", F.regexp_replace("host", "[^a-z0-9.-]", "_")), "newest")
    files.write_pages(newest, path)
    files.write_pages(newest.where("source = 'db_cc'").withColumn("attempts", F.lit(9)), path)
    back = files.read_pages(spark, path, newest.schema)
    return back.groupBy("source").agg(F.count("*").alias("n"), F.count("html").alias("n_bodies"), F.min("attempts").alias("least"), F.max("attempts").alias("most"), F.sum("nbytes").alias("n_bytes"))


def _repair(spark: SparkSession, log: DataFrame, wrong: Column, kind: str, name: str) -> DataFrame:
    """The store before and after: wrong rows corrected in the partitions that hold any, all others untouched."""
    path = _place(spark, name)
    log = stage(log.withColumn("host", F.regexp_replace("host", "[^a-z0-9.-]", "_")).withColumn("_w", F.coalesce(wrong, F.lit(False))), name)
    store = [c for c in log.columns if c != "_w"]
    files.write_pages(log.select(store), path)
    files.write_pages(S.repaired(log, F.col("_w"), kind).select(store), path)
    back = files.read_pages(spark, path, log.select(store).schema)
    return back.groupBy("source", "kind").agg(F.count("*").alias("n"), F.count("html").alias("n_bodies"), F.sum("nbytes").alias("n_bytes"))


def _derived(log: DataFrame) -> DataFrame:
    """Rows with final addresses of files, foreign types and bodies of files among them, so that every rule has rows."""
    i = F.col("id")
    final = F.when(i % 29 == 3, F.concat(F.lit("http://a.example/x"), i.cast("string"), F.lit(".PDF"))).when(i % 29 == 4, F.concat(F.lit("http://web.example/web/2020id_/http://a.example/"), i.cast("string"), F.lit(".jpg")))
    ctype = F.when(i % 31 == 5, F.lit("image/png")).otherwise(F.col("ctype"))
    html = F.when((i % 37 == 6) & (F.col("kind") == "ok"), F.lit(b" \n%PDF-1.4")).otherwise(F.col("html"))
    return log.withColumn("final_url", F.coalesce(final, F.col("final_url"))).withColumn("ctype", ctype).withColumn("html", html)


def repair_nonhtml(spark: SparkSession, d: str) -> DataFrame:
    """Stored rows that are no page become ``nonhtml`` and lose their body, by address, first bytes and the origin's type."""
    log = _derived(_log(spark, d).select("source", "host", *COLUMNS))
    return _repair(spark, log, S.non_html_rows(log), "nonhtml", "nonhtml")


def repair_dry_run(spark: SparkSession, d: str) -> DataFrame:
    """What that repair would change, without writing."""
    log = _derived(_log(spark, d).select("source", "host", *COLUMNS))
    return log.where(S.non_html_rows(log)).groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("host").alias("n_hosts"))


def repair_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Archive rows that no longer map to their page become ``unmapped`` and lose their body."""
    expected = wanted_keys(table(spark, d, "corpus")).where("prio = 0").select("id", "key")
    log = S.unmapped_rows(_log(spark, d).select("source", "host", *COLUMNS), expected)
    return _repair(spark, log.withColumnRenamed("_wrong", "_bad"), F.col("_bad"), "unmapped", "unmapped").select("source", "kind", "n", "n_bodies", "n_bytes")


def flushed_files(spark: SparkSession, d: str) -> DataFrame:
    """The log written as files of at most 200 rows each: rows, and whether any file holds more."""
    path = _place(spark, "flushed")
    files.write_flushed(table(spark, d, "pages").select("source", "id", "kind"), path, 200)
    per = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").cast("long").alias("n_rows"), (F.max("n") <= 200).alias("bounded"))


QUERIES = {f.__name__: f for f in (store_import, zstd_roundtrip, store_compact, repair_nonhtml, repair_dry_run, repair_mapping, flushed_files)}

_SUM = "CAST(sum(('0x' || md5(html)[1:8])::BIGINT) AS BIGINT)"
_LATEST = "(SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY source, id ORDER BY fetched_at DESC, attempts DESC, kind, final_url ASC NULLS LAST) = 1)"
_DERIVED = f"""(SELECT source, host, id, kind, nbytes, html, coalesce(CASE WHEN id % 29 = 3 THEN 'http://a.example/x' || id || '.PDF' WHEN id % 29 = 4 THEN 'http://web.example/web/2020id_/http://a.example/' || id || '.jpg' END, final_url) AS fin,
    CASE WHEN id % 31 = 5 THEN 'image/png' ELSE ctype END AS c, CASE WHEN id % 37 = 6 AND kind = 'ok' THEN '255044462D312E34' ELSE {_hex_head("coalesce(html, ''::BLOB)")} END AS hx FROM pages)"""
_BAD = f"""(SELECT *, kind = 'ok' AND {_NON_HTML} AS bad FROM (SELECT *, CASE WHEN source = 'db_wayback' THEN {Q.unwrapped("coalesce(fin, '')")} ELSE coalesce(fin, '') END AS f,
    CASE WHEN source IN ('db', 'db_alt') THEN lower(coalesce(c, '')) ELSE '' END AS ct FROM {_DERIVED}))"""
_UNM = f"""(SELECT p.*, p.kind = 'ok' AND source IN ('db_wayback', 'db_cc') AND {Q.canonical(Q.unwrapped("coalesce(final_url, '')"))} <> coalesce(w.key, '') AS bad FROM pages p LEFT JOIN {_WANT} w USING (id))"""
SQL = {
    "store_import": f"""SELECT source, kind, count(*) AS n, CAST(sum(nbytes) AS BIGINT) AS n_bytes, max(attempts) AS attempts, count(html) AS n_bodies,
        CAST(coalesce(sum(octet_length(html)), 0) AS BIGINT) AS body_bytes, coalesce({_SUM}, 0) AS body_sum FROM pages WHERE kind IN ('ok', 'home', 'notfound') AND source <> 'db_alt' GROUP BY 1, 2""",
    "zstd_roundtrip": f"SELECT source, count(*) AS n, count(html) AS n_bodies, {_SUM} AS body_sum FROM pages GROUP BY 1",
    "store_compact": f"""SELECT source, count(*) AS n, count(html) AS n_bodies, CASE WHEN source = 'db_cc' THEN 9 ELSE min(attempts) END AS least,
        CASE WHEN source = 'db_cc' THEN 9 ELSE max(attempts) END AS most, CAST(sum(nbytes) AS BIGINT) AS n_bytes FROM {_LATEST} GROUP BY source""",
    "repair_nonhtml": f"""SELECT source, CASE WHEN bad THEN 'nonhtml' ELSE kind END AS kind, count(*) AS n, count(html) FILTER (WHERE NOT bad) AS n_bodies, CAST(sum(nbytes) AS BIGINT) AS n_bytes FROM {_BAD} GROUP BY 1, 2""",
    "repair_dry_run": f"SELECT source, count(*) AS n, count(DISTINCT host) AS n_hosts FROM {_BAD} WHERE bad GROUP BY 1",
    "repair_mapping": f"""SELECT source, CASE WHEN bad THEN 'unmapped' ELSE kind END AS kind, count(*) AS n, count(html) FILTER (WHERE NOT bad) AS n_bodies, CAST(sum(nbytes) AS BIGINT) AS n_bytes FROM {_UNM} GROUP BY 1, 2""",
    "flushed_files": "SELECT count(*) AS n_rows, true AS bounded FROM pages",
}
