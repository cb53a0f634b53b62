"""Small cases of the operators of order, stores, books and formats: nulls, ties, empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.functions import formats as T
from millrace.functions import urls as U
from millrace.operators import books as B
from millrace.operators import store as S
from millrace.operators import windows as W
from millrace.sources import files, records


def log(spark, n=60, seed=1):
    r = random.Random(seed)
    rows = [(r.choice(["hot"] * 6 + ["a", None]), i, float(r.randint(0, 40)), r.random() < 0.7, r.randint(0, 9)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, id long, at double, bad boolean, v long").repartition(5)


def by_key(rows):
    out = {}
    for x in rows:
        out.setdefault(x[0], []).append(x)
    return out


def test_pacing(spark):
    rows, df = log(spark)
    want = {}
    for own in by_key(rows).values():
        free = float("-inf")
        for _, i, at, _, _ in sorted(own, key=lambda x: (x[2], x[1])):
            slot = max(at, free)
            want[i] = slot
            free = slot + 1.5
    assert {r["id"]: r["slot"] for r in W.paced(df, ("k",), "at", ("id",), 1.5).collect()} == pytest.approx(want)
    assert W.paced(df.limit(0), ("k",), "at", ("id",), 1.5).count() == 0


def test_runs_batches_and_totals_keep_null_keys(spark):
    rows, df = log(spark, 80, 2)
    run, cut, total, tried = {}, {}, {}, set()
    for own in by_key(rows).values():
        n = s = 0
        stopped = False
        for place, (_, i, _, bad, v) in enumerate(sorted(own, key=lambda x: x[1])):
            n = n + 1 if bad else 0
            s += v
            run[i], cut[i], total[i] = n, place // 7, s
            if not stopped:
                tried.add(i)
            stopped |= n >= 4
    assert {r["id"]: r["run"] for r in W.runs(df, ("k",), ("id",), F.col("bad")).collect()} == run
    assert {r["id"]: r["batch"] for r in W.batches(df, ("id",), 7, ("k",)).collect()} == cut
    assert {r["id"]: r["total"] for r in W.totals_so_far(df, ("k",), ("id",), "v").collect()} == total
    assert {r["id"] for r in W.cut_after(df, ("k",), ("id",), F.col("bad"), 4).collect()} == tried
    assert {r["id"] for r in W.running_share(df, ("k",), ("id",), "v").collect()} == {x[1] for x in rows}


def test_deltas_over_partitions(spark):
    rows, df = log(spark, 50, 3)
    d = df.groupBy("k", "at").agg(F.sum("v").alias("v"))
    run = W.totals_so_far(d, ("k",), ("at",), "v")
    got = {(r["k"], r["at"]): r["rate"] for r in W.deltas(run, ("k",), "at", "total").collect()}
    want = {}
    for key, own in by_key([(r["k"], r["at"], r["v"]) for r in d.collect()]).items():
        last = None
        for _, at, v in sorted(own, key=lambda x: x[1]):
            want[key, at] = None if last is None else round(v / (at - last), 6)
            last = at
    assert got == pytest.approx(want) if None not in want.values() else {k: v for k, v in got.items() if v is not None} == pytest.approx({k: v for k, v in want.items() if v is not None})
    assert {k for k, v in got.items() if v is None} == {k for k, v in want.items() if v is None}


def test_shuffled_list(spark):
    df = spark.createDataFrame([(i, f"h{i % 3}") for i in range(30)], "id long, host string").repartition(4)
    got = sorted(W.shuffled(df, F.col("id") * 7 % 11, F.col("host") == "h1", limit=25).collect(), key=lambda r: r["place"])
    want = sorted(range(30), key=lambda i: (i % 3 == 1, i * 7 % 11, i))[:25]
    assert [r["id"] for r in got] == want and [r["place"] for r in got] == list(range(25))


def test_stores(spark, tmp_path):
    rows = [("db", "a.x", i, "ok", bytearray(b"<p>%d" % i), "text/html", f"http://a.x/{i}") for i in range(6)] + [("db_cc", "b.x", 9, "ok", bytearray(b"%PDF-1"), "image/png", "http://b.x/9"), ("db", "b.x", 8, "ok", bytearray(b"x"), "image/png", None), ("db", "c.x", 7, "error", None, None, None)]
    df = spark.createDataFrame(rows, "source string, host string, id long, kind string, html binary, ctype string, final_url string")
    path = str(tmp_path / "store")
    files.write_pages(df, path)
    assert files.read_pages(spark, path, df.schema).count() == 9
    bad = {r["id"] for r in df.where(S.non_html_rows(df)).collect()}
    assert bad == {9, 8}  # first bytes at an archive, type at the origin
    wrong = session.stage(df.withColumn("w", S.non_html_rows(df)), "w")
    fixed = S.repaired(wrong, F.col("w"), "nonhtml").select(*df.columns, "corrected")
    assert {(r["host"], r["id"], r["kind"], r["html"] is None) for r in fixed.collect()} == {("b.x", 9, "nonhtml", True), ("b.x", 8, "nonhtml", True)}
    files.write_pages(fixed.select(df.columns), path)
    back = {r["id"]: r["kind"] for r in files.read_pages(spark, path, df.schema).collect()}
    assert back[9] == back[8] == "nonhtml" and back[7] == "error" and len(back) == 9
    packed = files.zstd_packed(df.select("id", "html"), "html")
    assert {r["id"]: r["html"] for r in files.zstd_unpacked(packed, "html").collect()} == {r[2]: r[4] for r in rows}
    assert files.unpacked_blob(b"\x28\xb5\x2f\xfdbroken") == b"\x28\xb5\x2f\xfdbroken" and files.unpacked_blob(None) is None
    files.write_flushed(df, str(tmp_path / "f"), 2)
    assert spark.read.parquet(str(tmp_path / "f")).groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0] <= 2


def test_unmapped(spark):
    df = spark.createDataFrame([("db_wayback", 1, "ok", "http://web.x/web/2020id_/http://a.x/p"), ("db_wayback", 2, "ok", "http://web.x/id_/http://a.x/q"), ("db_cc", 3, "ok", None), ("db_cc", 4, "ok", "http://a.x/r"), ("db", 5, "ok", "http://z")], "source string, id long, kind string, final_url string")
    want = spark.createDataFrame([(1, "a.x/p"), (2, "a.x/other"), (4, "a.x/r")], "id long, key string")
    assert {r["id"]: r["_wrong"] for r in S.unmapped_rows(df, want).collect()} == {1: False, 2: True, 3: False, 4: False, 5: False}


def test_books(spark):
    one = spark.range(1)
    parts = one.select(B.book_parts(F.lit("http://x/books/abc12/7//")).alias("p"), B.book_parts(F.lit("q")).alias("q"), B.bare_slug(F.lit("a1b22")).alias("s"), B.old_path(F.lit("http://www.o.x:80/a/b.html?x=1")).alias("o")).first()
    assert tuple(parts["p"]) == ("books", "abc12", 7) and tuple(parts["q"]) == (None, None, None) and (parts["s"], parts["o"]) == ("a1b", "/a/b.html")
    t = spark.createDataFrame([("herbs", "gan"), ("herbs", ""), ("other", "x")], "section string, slug string")
    assert [r[0] for r in t.select(B.templated(t, {"herbs": "/y_{first}/{slug}.html"})).collect()] == ["/y_g/gan.html", None, None]
    rows = spark.createDataFrame([(1, "a9", None), (2, "b", "c"), (3, None, None)], "id int, x string, y string")
    known = spark.createDataFrame([("a",), ("c",), ("b",), ("b",)], "candidate string")
    assert {r["id"]: r["found"] for r in B.first_hit(rows, [F.col("x"), B.bare_slug(F.col("x")), F.col("y")], known, ("id",)).collect()} == {1: "a", 2: "b", 3: None}
    aligned = spark.createDataFrame([("b", "aligned", 10), ("c", "rejected", 1)], "book string, status string, shift long")
    ids = spark.createDataFrame([("b", 11, "u1"), ("b", 12, "u2"), ("b", 13, "u3"), ("c", 2, "u4")], "book string, new_id long, url string")
    entries = spark.createDataFrame([("b", 1, 0, "/x/1.html"), ("b", 2, 1, "/x/2.html"), ("b", 2, 2, None), ("b", 3, 3, "http://o.x/3.html"), ("c", 1, 0, "/c")], "book string, si long, pos int, href string")
    found = B.chapters(aligned, ids, entries)
    assert {(r["new_id"], r["href"]) for r in found.collect()} == {(11, "/x/1.html"), (13, "http://o.x/3.html")}  # the later entry of 2 has no chapter
    caps = spark.createDataFrame([("2019", "http://o.x/3.html"), ("2020", "http://o.x:80/3.html?y"), ("2030", "http://o.x/3.html"), ("2019", "http://o.x/l/1.html")], "ts string, original string")
    got = B.book_map(found, caps, F.concat(F.lit("/l/"), F.col("si").cast("string"), F.lit(".html")), before="2025").collect()
    assert {tuple(r) for r in got} == {("u3", "http://o.x:80/3.html?y", "book-si k=10"), ("u1", "http://o.x/l/1.html", "book-si k=10")}


def test_formats(spark):
    r = spark.range(1).select(
        T.grouped(F.lit(1234567)).alias("n"), T.size_text(F.lit(3 << 30)).alias("g"), T.size_text(F.lit(1 << 19)).alias("m"), T.time_text(F.lit(86400.9)).alias("t"), T.labelled(F.lit("a"), {"a": "A"}).alias("a"), T.labelled(F.lit("b"), {"a": "A"}).alias("b"),
        U.unwrapped(F.lit("x/id_/http://y")).alias("u"), T.labelled(F.lit(None).cast("string"), {"a": "A"}).alias("z"),
    ).first()
    assert tuple(r) == ("1,234,567", "3.00 GB", "0.50 MB", "1970-01-02 00:00", "A", "b", "http://y", None)


def test_report_lines(spark):
    states = spark.createDataFrame([("stored", 3000), ("dead", 1)], "state string, n long")
    missing = spark.createDataFrame([(2, "http://h/2", "h", "dead"), (1, "http://h/1", "h", "dead"), (3, "http://g/3", "g", "robots")], "id long, url string, host string, reason string")
    red = spark.createDataFrame([("h", 1, 2, 0, 0)], "host string, same_article long, different_article long, non_html long, place long")
    got = [tuple(r) for r in files.markdown_report(states, missing, red, {"dead": "gone"}).select("section", "line").collect()]
    assert got == [
        ("1 states", "| stored | 3,000 |"), ("1 states", "| dead | 1 |"), ("2 reasons", "| gone | 2 |"), ("2 reasons", "| robots | 1 |"), ("3 hosts", "| h | 2 | gone |"), ("3 hosts", "| g | 1 | robots |"),
        ("4 redirects", "| h | 1 | 2 | 0 |"), ("5 pages", "3\thttp://g/3"), ("5 pages", "1\thttp://h/1"), ("5 pages", "2\thttp://h/2"),
    ]


def test_intake(spark):
    wanted = spark.createDataFrame([(1, "11"), (2, "12"), (3, None), (4, "14")], "id long, number string")
    text = "<PubmedArticle><PMID>11</PMID></PubmedArticle><PubmedArticle><PMID>11</PMID>long</PubmedArticle><PubmedArticle><PMID>99</PMID></PubmedArticle>"
    got = {r["id"]: (r["batch"], r["kind"], r["status"], r["nbytes"]) for r in records.record_intake(wanted, spark.createDataFrame([(text,), (None,)], "text string"), 2).collect()}
    assert got == {1: (0, "ok", 200, 50), 2: (0, "notfound", 404, 0), 4: (1, "notfound", 404, 0)}


def test_staging_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://x:7077"

    class Session:
        sparkContext = Context()
        conf = spark.conf

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError):
            session.shared_dir(Session())


def test_release(spark):
    df = session.stage(spark.range(5), "r")
    assert df.count() == 5
    session.release(spark)
    with pytest.raises(Exception):
        session.stage(spark.range(5), "s").unionByName(df).count()
