"""Report queries: coverage, missing pages, redirects, progress, order-dependent operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import align as A
from ..operators import reports as R
from ..operators import windows as W
from ..session import table
from . import sqlparts as Q
from .captures_q import _matches
from .pages_q import FINAL_SQL, derived_final

#: Hosts that only archives can serve, and hosts whose robots.txt forbids the pages (configuration of these queries).
PROBLEM_SUFFIX = ".invalid"
DISALLOWED_PREFIX = "ask."


def _problem(host: str = "host") -> Column:
    return F.col(host).endswith(PROBLEM_SUFFIX)


def _states(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "corpus").select("id", "url", U.host_key("url").alias("host"))
    log = table(spark, d, "pages").select("id", "source", "kind", F.lower(U.netloc("url")).alias("host"))
    archived = _matches(spark, d).select("id").union(_cc_ids(spark, d))
    return R.page_states(corpus, log, archived, _problem(), F.col("host").startswith(DISALLOWED_PREFIX))


def _cc_ids(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.captures import wanted_keys

    want = wanted_keys(table(spark, d, "corpus")).select("key", "id")
    return table(spark, d, "cc_index").select(U.canonical("url").alias("key")).distinct().join(want, "key").select("id")


def coverage_by_host(spark: SparkSession, d: str) -> DataFrame:
    return R.coverage(_states(spark, d))


def coverage_totals(spark: SparkSession, d: str) -> DataFrame:
    return R.totals(coverage_by_host(spark, d))


def coverage_sections(spark: SparkSession, d: str) -> DataFrame:
    s = _states(spark, d).where(_problem())
    return R.sections(s, F.split_part(U.url_path("url"), F.lit("/"), F.lit(2)))


def coverage_partition_check(spark: SparkSession, d: str) -> DataFrame:
    """Hosts whose states do not add up to their total: none."""
    c = coverage_by_host(spark, d)
    return c.where(F.col("total") != sum((F.col(s) for s in R.STATES), F.lit(0))).select("host", "total")


def coverage_report_check(spark: SparkSession, d: str) -> DataFrame:
    """The earlier report's own invariant, by row; indented rows are sections."""
    t = table(spark, d, "coverage")
    total = sum((F.col(s) for s in R.STATES), F.lit(0))
    return t.groupBy(F.when(F.col("host").startswith("  "), "section").otherwise("host").alias("level")).agg(
        F.count("*").alias("n"), F.count_if(F.col("total") == total).alias("n_exact"), F.sum("total").cast("long").alias("total")
    )


def top_hosts(spark: SparkSession, d: str) -> DataFrame:
    return coverage_by_host(spark, d).orderBy(F.desc("total"), "host").limit(25)


def missing_export(spark: SparkSession, d: str) -> DataFrame:
    """Pages that cannot be had, with a refined reason: a lookup of rejected groups splits one reason."""
    s = _states(spark, d).where(F.col("state").isin("no_source", "dead", "robots"))
    rejected = (
        table(spark, d, "missing").where("reason = 'no_source_book_rejected'").select(F.lower("host").alias("host")).distinct().withColumn("is_rejected", F.lit(True))
    )
    j = s.join(rejected, "host", "left")
    refined = (
        F.when((F.col("state") == "no_source") & F.col("url").contains("/tin/"), F.when(F.col("is_rejected"), "no_source_book_rejected").otherwise("no_source_not_archived"))
        .otherwise(F.col("state"))
    )
    return j.select("id", "url", "host", refined.alias("reason"))


def missing_reasons(spark: SparkSession, d: str) -> DataFrame:
    return missing_export(spark, d).groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("host").alias("n_hosts"))


def missing_reason_mode(spark: SparkSession, d: str) -> DataFrame:
    return R.main_value(table(spark, d, "missing"), "host", "reason")


def missing_listing(spark: SparkSession, d: str) -> DataFrame:
    """The report's listing per host and reason: a line per page, in id order, in parts of at most 1,000 ids."""
    line = F.struct("id", F.concat_ws("\t", F.col("id").cast("string"), "url").alias("l"))
    return table(spark, d, "missing").groupBy("host", "reason", F.floor(F.col("id") / 1000).cast("long").alias("part")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x.l), "\n").alias("listing"))


def _moved(spark: SparkSession, d: str) -> DataFrame:
    """The log with derived final addresses at the origin, so that every kind of redirect occurs."""
    p = table(spark, d, "pages").select("source", "host", "id", "url", "final_url", "kind")
    return p.withColumn("final_url", F.when(F.col("source") == "db", derived_final()).otherwise(F.col("final_url")))


def redirected_pages(spark: SparkSession, d: str) -> DataFrame:
    return R.redirected(_moved(spark, d)).groupBy("source", "id").agg(F.min("redirect").alias("redirect"))


def redirect_pivot(spark: SparkSession, d: str) -> DataFrame:
    return R.redirect_table(R.redirected(_moved(spark, d)))


def progress_pivot(spark: SparkSession, d: str) -> DataFrame:
    totals = table(spark, d, "corpus").groupBy(U.host_key("url").alias("host")).agg(F.count("*").alias("total"))
    return R.progress(table(spark, d, "pages").where("source = 'db'").select("host", "kind", "nbytes"), totals)


def progress_done_pct(spark: SparkSession, d: str) -> DataFrame:
    return progress_pivot(spark, d).select("host", "total", "done_pct")


def kind_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").groupBy("source", "kind").agg(F.count("*").alias("n"), F.sum("nbytes").cast("long").alias("n_bytes"))


def size_tolerance_join(spark: SparkSession, d: str) -> DataFrame:
    """Upload plan: local files against remote ones; nearly equal sizes are skipped, small files first."""
    local = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("long").alias("size"))
    remote = table(spark, d, "part").where("p_partkey % 7 <> 0").select("p_partkey", (F.col("p_size") + F.col("p_partkey") % 5 - 2).alias("remote"))
    j = local.join(remote, "p_partkey", "left")
    return j.select("p_partkey", "size", "remote", F.coalesce(F.abs(F.col("size") - F.col("remote")) < 2, F.lit(False)).alias("skipped"))


def set_operations(spark: SparkSession, d: str) -> DataFrame:
    """Union, intersection and difference of id sets of two sources."""
    p = table(spark, d, "pages").where("kind = 'ok'")
    a, b = p.where("source = 'db'").select("id"), p.where("source <> 'db'").select("id")
    one = lambda name, df: df.agg(F.lit(name).alias("op"), F.count("*").alias("n"))
    return one("union", a.union(b).distinct()).union(one("intersect", a.intersect(b))).union(one("except", a.subtract(b))).union(one("union_all", a.union(b)))


def consecutive_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Pages after which a pass over a host would stop: at the tenth block in a row, every third row counting as blocked first."""
    e = table(spark, d, "events").select("user_id", "event_id", F.col("event_type").isin("error", "view", "click").alias("bad"))
    r = W.runs(e, ("user_id",), ("event_id",), F.col("bad"))
    return r.groupBy("user_id").agg(F.max("run").alias("longest"), F.min(F.when(F.col("run") >= 10, F.col("event_id"))).alias("stop_at"))


def error_streak(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "pages").select("host", "source", "id", "fetched_at", "url", (F.col("kind") == "error").alias("bad")).distinct()
    r = W.runs(e, ("host",), ("fetched_at", "source", "id"), F.col("bad"))
    return r.groupBy("host").agg(F.max("run").alias("longest"), F.count_if(F.col("run") >= 2).alias("n_late"))


def batch_assign(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "corpus").select("id", U.host_key("url").alias("host"))
    return W.batches(c, ("id",), 30, ("host",)).groupBy("host", "batch").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


def rate_delta(spark: SparkSession, d: str) -> DataFrame:
    """Growth of each host's stored bytes between daily reports."""
    day = F.floor(F.col("fetched_at") / 86400).cast("long")
    daily = table(spark, d, "pages").groupBy("host", day.alias("day")).agg(F.sum("nbytes").cast("long").alias("n"))
    return W.deltas(W.totals_so_far(daily, ("host",), ("day",), "n"), ("host",), "day", "total").select("host", "day", "total", "rate")


def running_share(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "corpus").select("id", U.host_key("url").alias("host"), F.length("url").cast("long").alias("n"))
    return W.running_share(p, ("host",), ("n", "id"), "n").select("id", "done_before", "share_before")


def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    """Three pages a host in a pseudo-random order that any engine can repeat."""
    c = table(spark, d, "corpus").select("id", U.host_key("url").alias("host"), ((F.col("id") * 7919) % 1009).alias("draw"))
    return W.per_key(c, ("host",), ("draw", "id"), 3).select("host", "rank", "id")


def custom_rank_order(spark: SparkSession, d: str) -> DataFrame:
    """Sources in their order of preference, the rest last."""
    p = table(spark, d, "pages").groupBy("source").agg(F.count("*").alias("n"))
    return p.withColumn("place", W.rank_in(F.col("source"), ("db", "db_wayback", "db_alt")))


def epoch_seconds(column: str) -> Column:
    """Seconds since 1970 of a wall-clock time, whatever the session's time zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(column).cast("timestamp_ntz"))


def minute_rate(spark: SparkSession, d: str) -> DataFrame:
    w = F.window("ts", "1 minute")
    return table(spark, d, "events").groupBy(w.start.alias("minute"), "event_type").agg(F.count("*").alias("n")).withColumn("minute", epoch_seconds("minute"))


# Catalogs derived from the corpus: a book per (host, section), entries at page numbers.
def _books(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "corpus").select(U.site("url").alias("book"), (F.col("id") % 97).alias("si")).distinct()
    return p


def _items(spark: SparkSession, d: str) -> DataFrame:
    return _books(spark, d).select("book", "si", (F.col("si") % 3 != 0).alias("content"))


def _new_ids(spark: SparkSession, d: str) -> DataFrame:
    b = _books(spark, d).where((F.col("si") % 3 != 0) | (F.length("book") % 5 == 0))
    return b.where(~((F.length("book") % 4 == 0) & (F.col("si") > 60))).select("book", (F.col("si") + F.length("book") % 7).alias("new_id"))


def align_shift(spark: SparkSession, d: str) -> DataFrame:
    return A.align(_items(spark, d), _new_ids(spark, d))


def align_status(spark: SparkSession, d: str) -> DataFrame:
    return align_shift(spark, d).groupBy("status").agg(F.count("*").alias("books"), F.sum("n").cast("long").alias("ids"), F.sum("stray").cast("long").alias("stray"))


QUERIES = {
    f.__name__: f
    for f in (
        coverage_by_host, coverage_totals, coverage_sections, coverage_partition_check, coverage_report_check, top_hosts, missing_export, missing_reasons,
        missing_reason_mode, missing_listing, redirected_pages, redirect_pivot, progress_pivot, progress_done_pct, kind_counts, size_tolerance_join, set_operations,
        consecutive_blocks, error_streak, batch_assign, rate_delta, running_share, stratified_sample, custom_rank_order, minute_rate, align_shift, align_status,
    )
}

from .captures_q import _MATCH, _WANT  # noqa: E402

_ST = f"""(WITH c AS (SELECT id, url, {Q.host_key('url')} AS host FROM corpus),
    f AS (SELECT id, {Q.host_key('url')} AS host, max(kind = 'ok') AS o, max(source = 'db' AND kind IN ('notfound','home','http4xx')) AS dd,
        max(source = 'db' AND kind = 'robots') AS r FROM pages GROUP BY 1, 2),
    a AS (SELECT id FROM {_MATCH} UNION SELECT w.id FROM {_WANT} w JOIN (SELECT {Q.canonical('url')} AS key FROM cc_index) USING (key))
    SELECT c.id, c.url, c.host, a.id IS NOT NULL AS has_archive, CASE WHEN o THEN 'stored' WHEN dd THEN 'dead' WHEN r OR starts_with(c.host, 'ask.') THEN 'robots'
        WHEN ends_with(c.host, '.invalid') AND a.id IS NOT NULL THEN 'queued_archive' WHEN ends_with(c.host, '.invalid') THEN 'no_source' ELSE 'queued_direct' END AS state
    FROM c LEFT JOIN f USING (id, host) LEFT JOIN a USING (id))"""
_CNT = ", ".join(f"count(*) FILTER (WHERE state = '{s}') AS {s}" for s in R.STATES)
_COV = f"SELECT host, count(*) AS total, {_CNT} FROM {_ST} GROUP BY host"
_MISS = f"""SELECT s.id, s.url, s.host, CASE WHEN state = 'no_source' AND contains(url, '/tin/') THEN CASE WHEN r.host IS NOT NULL THEN 'no_source_book_rejected' ELSE 'no_source_not_archived' END
    ELSE state END AS reason FROM {_ST} s LEFT JOIN (SELECT DISTINCT lower(host) AS host FROM missing WHERE reason = 'no_source_book_rejected') r USING (host)
    WHERE state IN ('no_source', 'dead', 'robots')"""
_FIN = f"(CASE WHEN source = 'db_wayback' THEN {Q.unwrapped('final_url')} ELSE final_url END)"
_LOG = f"(SELECT source, host, id, url, kind, CASE WHEN source = 'db' THEN {FINAL_SQL} ELSE final_url END AS final_url FROM pages)"
_RED = f"(SELECT source, id, host, {Q.redirect_kind('url', 'f')} AS redirect FROM (SELECT *, {_FIN} AS f FROM {_LOG} WHERE kind = 'ok' AND final_url <> '' AND source <> 'db_alt'))"
_KC = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS {k}" for k in R.PROGRESS_KINDS)
_PROG = f"""SELECT host, {_KC}, coalesce(any_value(total), 0) AS total,
    CASE WHEN any_value(total) > 0 THEN round(100.0 * count(*) FILTER (WHERE kind IN ('ok','notfound','home','robots','http4xx')) / any_value(total), 4) END AS done_pct,
    CAST(round(sum(nbytes) / 1048576.0) AS BIGINT) AS mb
    FROM pages LEFT JOIN (SELECT {Q.host_key('url')} AS host, count(*) AS total FROM corpus GROUP BY 1) USING (host) WHERE source = 'db' GROUP BY host"""


def _runs(src: str, key: str, order: str) -> str:
    return f"""(SELECT *, sum(bad::INT) OVER (PARTITION BY {key}, island ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS run FROM (
        SELECT *, sum((NOT bad)::INT) OVER (PARTITION BY {key} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS island FROM {src}))"""


_BOOKS = f"(SELECT DISTINCT {Q.site('url')} AS book, id % 97 AS si FROM corpus)"
_NEW = f"(SELECT book, si + length(book) % 7 AS new_id FROM {_BOOKS} WHERE (si % 3 <> 0 OR length(book) % 5 = 0) AND NOT (length(book) % 4 = 0 AND si > 60))"
_ALIGN = f"""(WITH content AS (SELECT book, si FROM {_BOOKS} WHERE si % 3 <> 0), n AS (SELECT book, count(*) AS n, min(new_id) AS first_id FROM {_NEW} GROUP BY 1),
    h AS (SELECT c.book, n.first_id - c.si AS k, count(*) AS hits FROM content c JOIN n USING (book) JOIN {_NEW} i USING (book)
        JOIN content c2 ON c2.book = c.book AND c2.si = i.new_id - (n.first_id - c.si) GROUP BY 1, 2),
    s AS (SELECT h.*, hits / n.n AS share FROM h JOIN n USING (book)),
    b AS (SELECT book, first(k ORDER BY share DESC, k) AS shift, max(share) AS share, count(*) FILTER (WHERE share >= 0.995) AS m FROM s GROUP BY 1),
    st AS (SELECT i.book, count(*) AS stray FROM {_NEW} i JOIN b USING (book) WHERE (i.book, i.new_id - b.shift) NOT IN (SELECT book, si FROM {_BOOKS}) GROUP BY 1)
    SELECT n.book, n.n, CASE WHEN share >= 0.995 AND m = 1 THEN 'aligned' WHEN m > 1 THEN 'ambiguous' ELSE 'rejected' END AS status, shift,
        round(coalesce(share, 0.0), 4) AS exact_share, CASE WHEN shift IS NOT NULL THEN coalesce(stray, 0) ELSE n.n END AS stray, coalesce(m, 0) AS shifts_matching
    FROM n LEFT JOIN b USING (book) LEFT JOIN st USING (book))"""
SQL = {
    "coverage_by_host": _COV,
    "coverage_totals": "SELECT " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("total", *R.STATES)) + f" FROM ({_COV})",
    "coverage_sections": f"""SELECT split_part({Q.path('url')}, '/', 2) AS section, count(*) AS total, count(*) FILTER (WHERE state = 'stored') AS stored,
        count(*) FILTER (WHERE state <> 'stored' AND has_archive) AS queued_archive, count(*) FILTER (WHERE state <> 'stored' AND NOT has_archive) AS no_source
        FROM {_ST} WHERE ends_with(host, '.invalid') GROUP BY 1""",
    "coverage_partition_check": f"SELECT host, total FROM ({_COV}) WHERE total <> stored + dead + robots + queued_archive + no_source + queued_direct",
    "coverage_report_check": """SELECT CASE WHEN starts_with(host, '  ') THEN 'section' ELSE 'host' END AS level, count(*) AS n,
        count(*) FILTER (WHERE total = stored + dead + robots + queued_archive + no_source + queued_direct) AS n_exact, CAST(sum(total) AS BIGINT) AS total FROM coverage GROUP BY 1""",
    "top_hosts": f"SELECT * FROM ({_COV}) ORDER BY total DESC, host LIMIT 25",
    "missing_export": _MISS,
    "missing_reasons": f"SELECT reason, count(*) AS n, count(DISTINCT host) AS n_hosts FROM ({_MISS}) GROUP BY 1",
    "missing_reason_mode": "SELECT host, reason, count(*) AS n FROM missing GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY host ORDER BY count(*) DESC, reason) = 1",
    "missing_listing": "SELECT host, reason, id // 1000 AS part, string_agg(id || chr(9) || url, chr(10) ORDER BY id, url) AS listing FROM missing GROUP BY 1, 2, 3",
    "redirected_pages": f"SELECT source, id, min(redirect) AS redirect FROM {_RED} WHERE redirect IS NOT NULL GROUP BY 1, 2",
    "redirect_pivot": "SELECT host, " + ", ".join(f"count(*) FILTER (WHERE redirect = '{k}') AS {k}" for k in R.REDIRECTS) + f" FROM {_RED} WHERE redirect IS NOT NULL GROUP BY 1",
    "progress_pivot": _PROG,
    "progress_done_pct": f"SELECT host, total, done_pct FROM ({_PROG})",
    "kind_counts": "SELECT source, kind, count(*) AS n, CAST(sum(nbytes) AS BIGINT) AS n_bytes FROM pages GROUP BY 1, 2",
    "size_tolerance_join": """SELECT a.p_partkey, CAST(a.p_size AS BIGINT) AS size, b.remote, coalesce(abs(a.p_size - b.remote) < 2, false) AS skipped FROM part a
        LEFT JOIN (SELECT p_partkey, p_size + p_partkey % 5 - 2 AS remote FROM part WHERE p_partkey % 7 <> 0) b USING (p_partkey)""",
    "set_operations": """WITH a AS (SELECT id FROM pages WHERE kind = 'ok' AND source = 'db'), b AS (SELECT id FROM pages WHERE kind = 'ok' AND source <> 'db')
        SELECT 'union' AS op, count(*) AS n FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'intersect', count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
        UNION ALL SELECT 'except', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'union_all', count(*) FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""",
    "consecutive_blocks": f"""SELECT user_id, CAST(max(run) AS BIGINT) AS longest, min(event_id) FILTER (WHERE run >= 10) AS stop_at FROM
        {_runs("(SELECT user_id, event_id, event_type IN ('error', 'view', 'click') AS bad FROM events)", "user_id", "event_id")} GROUP BY 1""",
    "error_streak": f"""SELECT host, CAST(max(run) AS BIGINT) AS longest, count(*) FILTER (WHERE run >= 2) AS n_late FROM
        {_runs("(SELECT DISTINCT host, source, id, fetched_at, url, kind = 'error' AS bad FROM pages)", "host", "fetched_at, source, id")} GROUP BY 1""",
    "batch_assign": f"""SELECT host, batch, count(*) AS n, min(id) AS first_id FROM (SELECT id, host, (row_number() OVER (PARTITION BY host ORDER BY id) - 1) // 30 AS batch
        FROM (SELECT id, {Q.host_key('url')} AS host FROM corpus)) GROUP BY 1, 2""",
    "rate_delta": """WITH p AS (SELECT host, CAST(floor(fetched_at / 86400) AS BIGINT) AS day, sum(nbytes) AS n FROM pages GROUP BY 1, 2),
        r AS (SELECT host, day, CAST(sum(n) OVER (PARTITION BY host ORDER BY day) AS BIGINT) AS total FROM p)
        SELECT *, round((total - lag(total) OVER w) / (day - lag(day) OVER w), 6) AS rate FROM r WINDOW w AS (PARTITION BY host ORDER BY day)""",
    "running_share": f"""SELECT id, CAST(coalesce(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS done_before,
        round(coalesce(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(n) OVER (PARTITION BY host), 6) AS share_before
        FROM (SELECT id, {Q.host_key('url')} AS host, length(url) AS n FROM corpus) WINDOW w AS (PARTITION BY host ORDER BY n, id)""",
    "stratified_sample": f"""SELECT host, CAST(row_number() OVER (PARTITION BY host ORDER BY (id * 7919) % 1009, id) AS INT) AS rank, id
        FROM (SELECT id, {Q.host_key('url')} AS host FROM corpus) QUALIFY rank <= 3""",
    "custom_rank_order": "SELECT source, count(*) AS n, CAST(coalesce(list_position(['db', 'db_wayback', 'db_alt'], source) - 1, 3) AS INT) AS place FROM pages GROUP BY 1",
    "minute_rate": "SELECT CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS minute, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "align_shift": f"SELECT * FROM {_ALIGN}",
    "align_status": f"SELECT status, count(*) AS books, CAST(sum(n) AS BIGINT) AS ids, CAST(sum(stray) AS BIGINT) AS stray FROM {_ALIGN} GROUP BY 1",
}
