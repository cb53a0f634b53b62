"""Readers with explicit schemas (nothing is inferred) and writers for text formats.

Headerless tables, CSV, JSON lines, nested status documents, sorted index
blocks, directory listings; each writer has the options its reader expects, so
a round trip returns the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.formats import grouped, labelled
from ..session import ship

CAPTURES = "ts string, original string"
RECORDS = "url string, ts string, filename string, offset long, length long, host string"
ALTERNATES = "corpus_url string, archived_url string, method string"
COVERAGE = "host string, total long, stored long, dead long, robots long, queued_archive long, no_source long, queued_direct long"
MISSING = "id long, url string, host string, reason string"
STATUS = (
    "updated string, elapsed_min double, "
    "groups map<string, struct<queue: long, rate: double, disabled: boolean, strikes: int, paused_for: long, dead_hosts: array<string>>>, "
    "hosts map<string, map<string, long>>"
)


def stem(path_column: str = "_metadata.file_path") -> F.Column:
    """File name without folder and extension, e.g. the host a file is named after."""
    return F.regexp_extract(F.col(path_column), r"([^/]+?)(?:\.[A-Za-z0-9]+)*$", 1)


def read_tsv(spark: SparkSession, path: str, schema: str, with_stem: str | None = None) -> DataFrame:
    """Headerless tab-separated files; ``with_stem`` adds the file's stem under that name."""
    df = spark.read.schema(schema).option("sep", "\t").option("header", False).option("quote", '"').option("escape", '"').csv(path)
    return df.select("*", stem().alias(with_stem)) if with_stem else df


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("ignoreLeadingWhiteSpace", False).csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """Nested status documents; counter names are map keys, not columns."""
    return spark.read.schema(STATUS).option("multiLine", True).json(path)


def read_index_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Sorted index lines ``key ts {json}`` of gzip blocks as ``key, ts, url, status, mime, filename, offset, length``."""
    parts = F.split("value", " ", 3)
    schema = "url string, status string, mime string, `mime-detected` string, filename string, offset string, length string"
    lines = spark.read.text(path).where(F.size(parts) == 3).select(parts[0].alias("key"), parts[1].alias("ts"), F.from_json(parts[2], schema).alias("r"))
    mime = F.coalesce(F.nullif(F.col("r.mime-detected"), F.lit("")), F.nullif(F.col("r.mime"), F.lit("")), F.lit(""))
    return lines.select(
        "key", "ts", "r.url", "r.status", mime.alias("mime"), "r.filename", F.expr("try_cast(r.offset AS long)").alias("offset"), F.expr("try_cast(r.length AS long)").alias("length")
    )


def read_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, length`` of files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length")


def read_lenient_text(spark: SparkSession, path: str) -> DataFrame:
    """``path, text`` of whole files; bytes that are no UTF-8 are dropped."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [None if c is None else c.decode("utf-8", "ignore") for c in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=["path", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, text string")


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", False).option("quote", '"').option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with header; ``one_file`` is for reports of a bounded size."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


#: Rows of one source and host that one file holds, about, and the most files of a host.
PAGES_PER_FILE, HOST_FILES = 100_000, 1024


def write_pages(df: DataFrame, path: str, level: int = 6) -> None:
    """Page store partitioned by source and host, bodies compressed; only the partitions written are replaced.

    A host's rows are spread over files by a hash of their id, as many as its
    number of rows needs, so the hottest host is no larger task than the rest.
    """
    counts = df.groupBy("source", "host").agg(F.least(F.ceil(F.count("*") / PAGES_PER_FILE), F.lit(HOST_FILES)).cast("int").alias("_files"))
    rows = df.join(counts, ["source", "host"]).withColumn("_bucket", F.pmod(F.xxhash64("id"), F.col("_files"))).drop("_files")
    rows.repartition("source", "host", "_bucket").drop("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").option(
        "parquet.compression.codec.zstd.level", level
    ).partitionBy("source", "host").parquet(path)


def read_pages(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A page store written by :func:`write_pages`; source and host prune partitions."""
    return spark.read.schema(schema).parquet(path)


def write_flushed(df: DataFrame, path: str, rows: int = 200) -> None:
    """Files of at most so many rows each, as a buffer that is flushed at that size would leave them."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)


def _coded(df: DataFrame, column: str, change) -> DataFrame:
    """A binary column changed value by value in Arrow batches; other columns pass by."""
    ship(df.sparkSession)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                columns = list(part.columns)
                columns[at] = pa.array([None if v is None else change(v) for v in columns[at].to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return df.mapInArrow(run, df.schema)


def zstd_packed(df: DataFrame, column: str, level: int = 6) -> DataFrame:
    """Bodies as zstd blobs, as page stores hold them; null stays null."""
    import zstandard

    return _coded(df, column, lambda v: zstandard.ZstdCompressor(level=level).compress(v))


def unpacked_blob(blob: bytes | None) -> bytes | None:
    """Body of a zstd blob; bytes that are none stay as they are."""
    import zstandard

    if blob is None or not blob.startswith(zstandard.FRAME_HEADER):
        return blob
    try:
        return zstandard.ZstdDecompressor().decompressobj().decompress(blob)
    except zstandard.ZstdError:
        return blob


def zstd_unpacked(df: DataFrame, column: str) -> DataFrame:
    """Bodies of zstd blobs; a value that is none stays as it is."""
    return _coded(df, column, unpacked_blob)


def status_groups(status: DataFrame) -> DataFrame:
    """One row per group of a status document, longest queue first where shown."""
    g = status.select("updated", F.explode("groups").alias("name", "g"))
    return g.select("updated", "name", "g.*").withColumn("shown", (F.col("queue") > 0) | F.col("disabled") | (F.col("paused_for") > 0))


def status_hosts(status: DataFrame) -> DataFrame:
    """One row per host and counter of a status document."""
    hosts = status.select("updated", F.explode("hosts").alias("host", "counts"))
    return hosts.select("updated", "host", F.explode("counts").alias("kind", "n"))


def markdown_report(states: DataFrame, missing: DataFrame, redirects: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Missing-page report as numbered lines (``section, place, line``), made and ordered without a driver.

    ``states`` has a row per state, ``missing`` one per page (``id, url, host,
    reason``), ``redirects`` the sorted pivot. Sections are the counts, the
    reasons and hosts by falling count, the redirects, and the list of pages per
    host and reason. Lines of a section are in the order of ``place``.
    """
    reason = labelled(F.col("reason"), labels)
    line = lambda *parts: F.concat_ws(" ", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    counts = states.select(F.lit("1 states").alias("section"), F.struct((-F.col("n")).alias("a"), F.col("state").alias("b"), F.lit(0).cast("long").alias("c")).alias("place"), line("|", F.col("state"), "|", grouped(F.col("n")), "|").alias("line"))
    by_reason = missing.groupBy("reason").agg(F.count("*").alias("n"))
    reasons = by_reason.select(F.lit("2 reasons").alias("section"), F.struct((-F.col("n")).alias("a"), F.col("reason").alias("b"), F.lit(0).cast("long").alias("c")).alias("place"), line("|", reason, "|", grouped(F.col("n")), "|").alias("line"))
    pairs = missing.groupBy("host", "reason").agg(F.count("*").alias("n"))
    by_host = pairs.groupBy("host").agg(F.sum("n").alias("total"), F.min(F.struct((-F.col("n")).alias("m"), "reason")).alias("x")).select("host", "total", "x.reason")
    hosts = by_host.select(F.lit("3 hosts").alias("section"), F.struct((-F.col("total")).alias("a"), F.col("host").alias("b"), F.lit(0).cast("long").alias("c")).alias("place"), line("|", F.col("host"), "|", grouped(F.col("total")), "|", reason, "|").alias("line"))
    kinds = [c for c in redirects.columns if c not in ("host", "place")]
    moved = redirects.select(
        F.lit("4 redirects").alias("section"), F.struct(F.col("place").cast("long").alias("a"), F.col("host").alias("b"), F.lit(0).cast("long").alias("c")).alias("place"), line("|", F.col("host"), *[x for k in kinds for x in ("|", grouped(F.col(k)))], "|").alias("line")
    )
    listed = missing.select(
        F.lit("5 pages").alias("section"), F.struct(F.lit(0).cast("long").alias("a"), F.concat_ws("/", "host", "reason").alias("b"), F.col("id").alias("c")).alias("place"), F.concat_ws("\t", F.col("id").cast("string"), "url").alias("line")
    )
    return counts.unionByName(reasons).unionByName(hosts).unionByName(moved).unionByName(listed).orderBy("section", "place")
