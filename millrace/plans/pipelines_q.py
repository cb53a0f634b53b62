"""Queries of the longer pipelines: work lists of passes, intakes, samples and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import urls as U
from ..operators import align as A
from ..operators import books as B
from ..operators import store as S
from ..operators import windows as W
from ..session import table
from ..sources import records
from . import sqlparts as Q
from .mapping_q import _LINK, _NUM, _P, _U, _entries, _ids, book_map

MIB = 1 << 20


def missing_pass(spark: SparkSession, d: str) -> DataFrame:
    """Work list of the missing pass: pages without a body of the origin, 2,000 in all."""
    have = table(spark, d, "pages").where("source = 'db' and kind = 'ok' and html is not null").select("id").distinct()
    todo = table(spark, d, "corpus").select("id", U.host_key("url").alias("host")).join(have, "id", "left_anti")
    return W.shuffled(todo, F.col("id"), F.lit(False), limit=2000).select("place", "id", "host")


def retry_passes(spark: SparkSession, d: str) -> DataFrame:
    """Pages queued in each pass if every try failed: a page comes back until its attempts are used up."""
    p = S.pending(table(spark, d, "corpus"), table(spark, d, "pages").select("id", "kind", "attempts"))
    passes = p.select(F.explode(F.sequence(F.lit(1), F.lit(S.MAX_ATTEMPTS) - F.col("attempts"))).alias("pass"))
    return passes.groupBy("pass").agg(F.count("*").alias("n_queued"))


def cut_streaks(spark: SparkSession, d: str) -> DataFrame:
    """What a run would have tried: events of seven queues up to the sixtieth in a row that is no purchase."""
    e = table(spark, d, "events").select((F.col("user_id") % 7).alias("queue"), "event_id", (F.col("event_type") != "purchase").alias("bad"))
    out = W.cut_after(e, ("queue",), ("event_id",), F.col("bad"), 60)
    return out.groupBy("queue").agg(F.count("*").alias("n_tried"), F.max("event_id").alias("last_id"))


def queue_order(spark: SparkSession, d: str) -> DataFrame:
    """Groups with anything in their queue, longest first."""
    g = table(spark, d, "pages").groupBy("host").agg(F.count_if(F.col("kind") == "error").alias("queue")).where("queue > 0").withColumn("_down", -F.col("queue"))
    return W.batches(g, ("_down", "host"), 1).select(F.col("batch").alias("place"), "host", "queue")


def corpus_books(spark: SparkSession, d: str) -> DataFrame:
    """Numbered pages per book: how many, from which number to which."""
    c = table(spark, d, "corpus").select(F.regexp_replace("url", r"[?#].*$|\.html?$", "").alias("u")).select(B.book_parts(F.col("u")).alias("p")).select("p.*")
    return c.where("number is not null").groupBy("section", "slug").agg(F.count_distinct("number").alias("n"), F.min("number").alias("first"), F.max("number").alias("last"))


def book_report(spark: SparkSession, d: str) -> DataFrame:
    """Books, pages and archived pages by outcome of the alignment."""
    entries, ids = _entries(spark, d), _ids(spark, d)
    aligned = A.align(entries.select("book", "si", F.col("href").isNotNull().alias("content")).distinct(), ids.select("book", "new_id"))
    archived = book_map(spark, d).join(ids, "url").groupBy("book").agg(F.count("*").alias("archived"))
    return aligned.join(archived, "book", "left").groupBy("status").agg(F.count("*").alias("books"), F.sum("n").cast("long").alias("urls"), F.coalesce(F.sum("archived"), F.lit(0)).cast("long").alias("archived"))


def record_intake(spark: SparkSession, d: str) -> DataFrame:
    """Numbered records asked for in batches of 200 and taken from XML answers; every tenth is not returned, some come twice or unasked."""
    c = table(spark, d, "corpus").select("id", (F.col("id") + 5_000_000).cast("string").alias("number"))
    rec = F.concat(F.lit('<PubmedArticle><PMID Version="1">'), "number", F.lit("</PMID><T>"), F.repeat(F.lit("x"), (F.col("id") % 9).cast("int")), F.lit("</T></PubmedArticle>"))
    answers = c.where("id % 10 <> 3").withColumn("r", F.when(F.col("id") % 6 == 1, F.concat(rec, F.lit("\n"), rec)).otherwise(rec)).groupBy(F.floor(F.col("id") / 50).alias("b")).agg(F.array_join(F.collect_list("r"), "\n").alias("text"))
    return records.record_intake(c.where("id % 4 <> 0"), answers.select("text"), 200).groupBy("kind", "status").agg(F.count("*").alias("n"), F.sum("nbytes").alias("n_bytes"), F.count_distinct("batch").alias("n_batches"), F.count("record").alias("n_records"))


def upload_plan(spark: SparkSession, d: str) -> DataFrame:
    """Files against those already there: same size within 1 MiB is skipped; small files first, with what lies before each."""
    key = F.col("p_partkey")
    local = table(spark, d, "part").select("p_partkey", (F.col("p_size").cast("long") * MIB * 3).alias("size"))
    remote = table(spark, d, "part").where("p_partkey % 7 <> 0").select("p_partkey", (F.col("p_size").cast("long") * MIB * 3 + (key % 5 - 2) * (MIB // 2)).alias("remote"))
    j = local.join(remote, "p_partkey", "left").withColumn("skipped", F.coalesce(F.abs(F.col("remote") - F.col("size")) < MIB, F.lit(False))).withColumn("cell", key % 11)
    done = W.running_share(j, ("cell",), ("size", "p_partkey"), "size")
    return done.select("p_partkey", "skipped", "done_before", "share_before")


def upload_totals(spark: SparkSession, d: str) -> DataFrame:
    """Files and bytes of that plan, to send and to skip."""
    p = upload_plan(spark, d).join(table(spark, d, "part").select("p_partkey", (F.col("p_size").cast("long") * MIB * 3).alias("size")), "p_partkey")
    return p.groupBy("skipped").agg(F.count("*").alias("n_files"), F.sum("size").alias("n_bytes"))


def probe_sample(spark: SparkSession, d: str) -> DataFrame:
    """Two pages a host with what a probe would note: status (-1 for none), where it ended, type, size and title."""
    p = S.latest(table(spark, d, "pages").where("source = 'db'"))
    draw = W.per_key(p.withColumn("draw", (F.col("id") * 7919) % 1009), ("host",), ("draw", "id"), 2)
    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("long")
    title = F.coalesce(C.page_title(F.col("html").cast("string")), F.lit(""))
    return draw.select(
        "host", "id", F.coalesce("status", F.lit(-1)).alias("status"), F.substring(F.coalesce("final_url", F.lit("")), 1, 100).alias("final"), F.coalesce("ctype", F.lit("")).alias("ctype"), size.alias("size"), title.alias("title"),
    )


QUERIES = {
    f.__name__: f
    for f in (missing_pass, retry_passes, cut_streaks, queue_order, corpus_books, book_report, record_intake, upload_plan, upload_totals, probe_sample)
}
_DONE = "('ok','notfound','home','robots','http4xx','nonhtml')"
_PART = f"""(SELECT p_partkey, p_size::BIGINT * {3 * MIB} AS size, p_partkey % 11 AS cell, CASE WHEN p_partkey % 7 <> 0 THEN abs((p_partkey % 5 - 2) * {MIB // 2}) < {MIB} ELSE false END AS skipped FROM part)"""
_HIT = "(si % 10 <> 4 AND si % 4 = 0) OR si % 2 = 1"
SQL = {
    "missing_pass": f"""SELECT row_number() OVER (ORDER BY id) - 1 AS place, id, {Q.host_key('url')} AS host FROM corpus WHERE id NOT IN (SELECT id FROM pages WHERE source = 'db' AND kind = 'ok' AND html IS NOT NULL)
        QUALIFY place < 2000""",
    "retry_passes": f"""WITH p AS (SELECT c.id, coalesce(a.attempts, 0) AS attempts FROM corpus c LEFT JOIN (SELECT id, max(attempts) AS attempts FROM pages GROUP BY id) a USING (id)
        WHERE c.id NOT IN (SELECT id FROM pages WHERE kind IN {_DONE} OR attempts >= 5)) SELECT CAST(g AS INT) AS pass, count(*) AS n_queued FROM p, unnest(range(1, 6 - attempts)) AS t(g) GROUP BY 1""",
    "cut_streaks": """WITH e AS (SELECT user_id % 7 AS queue, event_id, event_type <> 'purchase' AS bad FROM events), i AS (SELECT *, sum((NOT bad)::INT) OVER (PARTITION BY queue ORDER BY event_id) AS island FROM e),
        r AS (SELECT *, sum(bad::INT) OVER (PARTITION BY queue, island ORDER BY event_id) AS run FROM i), s AS (SELECT queue, min(event_id) FILTER (WHERE run >= 60) AS stop FROM r GROUP BY 1)
        SELECT queue, count(*) AS n_tried, max(event_id) AS last_id FROM r JOIN s USING (queue) WHERE stop IS NULL OR event_id <= stop GROUP BY 1""",
    "queue_order": "SELECT row_number() OVER (ORDER BY queue DESC, encode(host)) - 1 AS place, host, queue FROM (SELECT host, count(*) FILTER (WHERE kind = 'error') AS queue FROM pages GROUP BY 1) WHERE queue > 0",
    "corpus_books": f"""WITH p AS (SELECT CASE WHEN len({_P}) >= 3 THEN {_P}[-3] END AS section, CASE WHEN len({_P}) >= 2 THEN {_P}[-2] END AS slug, TRY_CAST(CASE WHEN regexp_full_match({_P}[-1], '[+-]?\\d+') THEN {_P}[-1] END AS BIGINT) AS number FROM corpus)
        SELECT section, slug, count(DISTINCT number) AS n, min(number) AS first, max(number) AS last FROM p WHERE number IS NOT NULL GROUP BY 1, 2""",
    "book_report": f"""WITH l AS {_LINK}, good AS (SELECT DISTINCT book FROM l), n AS (SELECT book, count(*) AS n FROM {_NUM} WHERE si % 3 <> 0 GROUP BY 1), a AS (SELECT book, count(*) AS archived FROM l WHERE {_HIT} GROUP BY 1)
        SELECT CASE WHEN good.book IS NOT NULL THEN 'aligned' ELSE 'ambiguous' END AS status, count(*) AS books, CAST(sum(n) AS BIGINT) AS urls, CAST(coalesce(sum(archived), 0) AS BIGINT) AS archived
        FROM n LEFT JOIN good USING (book) LEFT JOIN a USING (book) GROUP BY 1""",
    "record_intake": """WITH c AS (SELECT id, row_number() OVER (ORDER BY CAST(id + 5000000 AS VARCHAR)) - 1 AS n FROM corpus WHERE id % 4 <> 0), r AS (SELECT *, id % 10 <> 3 AS hit,
            length('<PubmedArticle><PMID Version="1"></PMID><T></T></PubmedArticle>') + length(CAST(id + 5000000 AS VARCHAR)) + id % 9 AS size FROM c)
        SELECT CASE WHEN hit THEN 'ok' ELSE 'notfound' END AS kind, CASE WHEN hit THEN 200 ELSE 404 END AS status, count(*) AS n, CAST(sum(CASE WHEN hit THEN size ELSE 0 END) AS BIGINT) AS n_bytes, count(DISTINCT n // 200) AS n_batches, count(*) FILTER (WHERE hit) AS n_records
        FROM r GROUP BY 1, 2""",
    "upload_plan": f"""SELECT p_partkey, skipped, CAST(coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS done_before,
        round(coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(size) OVER (PARTITION BY cell), 6) AS share_before FROM {_PART} WINDOW w AS (PARTITION BY cell ORDER BY size, p_partkey)""",
    "upload_totals": f"SELECT skipped, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS n_bytes FROM {_PART} GROUP BY 1",
    "probe_sample": """WITH p AS (SELECT * FROM pages WHERE source = 'db' QUALIFY row_number() OVER (PARTITION BY id ORDER BY fetched_at DESC, attempts DESC, kind, final_url ASC NULLS LAST) = 1),
        s AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY host ORDER BY (id * 7919) % 1009, id) <= 2)
        SELECT host, id, coalesce(status, -1) AS status, coalesce(final_url, '')[1:100] AS final, coalesce(ctype, '') AS ctype, coalesce(octet_length(html), 0) AS size,
            coalesce(left(regexp_replace(regexp_extract(decode(html), '(?is)<title[^>]*>(.*?)</title>', 1), '^\\s+|\\s+$', '', 'g'), 60), '') AS title FROM s""",
}
