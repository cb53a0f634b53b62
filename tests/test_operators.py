import datetime
import gzip
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from millrace.functions import classify as C
from millrace.operators import align, captures, keyed_sums, ranges, reports, store, windows
from millrace.sources import files, records
from millrace.streaming import replay


def test_keyed_sums(spark, monkeypatch):
    r = random.Random(1)
    rows = [(r.choice(["hot"] * 50 + [None, "a", "B", ""]), r.randint(-5, 5), "x") for _ in range(5000)]
    df = spark.createDataFrame(rows, "k string, v int, n_rows string").repartition(7)
    want = {}
    for k, v, _ in rows:
        a = want.setdefault(k, [0, 0])
        a[0] += 1
        a[1] += v
    for keys in (keyed_sums.BLOCK_KEYS, 1):
        monkeypatch.setattr(keyed_sums, "BLOCK_KEYS", keys)
        got = {x["k"]: [x["n_rows"], x["s"]] for x in keyed_sums.keyed_sums(df, "k", {"s": F.col("v")}).collect()}
        assert got == want
    assert keyed_sums.keyed_sums(df.limit(0), "k", {"s": F.col("v")}).count() == 0


def test_keyed_sums_two_levels(spark, monkeypatch):
    monkeypatch.setattr(keyed_sums, "FAN_IN", 2)
    df = spark.range(0, 1000, 1, 9).select((F.col("id") % 3).cast("string").alias("k"), F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")).alias("v"))
    got = {x["k"]: (x["n_rows"], x["s"]) for x in keyed_sums.keyed_sums(df, "k", {"s": F.col("v")}).collect()}
    assert got == {str(m): (len(range(m, 1000, 3)), sum(i for i in range(m, 1000, 3) if i % 10)) for m in range(3)}


def kinds(spark, rows, **kw):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s int, f string, b binary, c string")
    k = C.fetch_kind(F.col("s"), F.col("f"), F.col("b"), F.col("c"), **kw)
    return [x["k"] for x in df.select("i", k.alias("k")).orderBy("i").collect()]


def test_classification(spark):
    page = b"<html>" + b"x" * 3000
    u = "http://a.x/p"
    slider = C.SLIDER.encode()
    rows = [
        (200, u, page, "text/html"), (200, "http://a.x/verify.html", page, ""), (200, "http://a.x/CAPTCHA", page, ""), (200, u, b"y" * 5970 + slider, ""),
        (200, u, b"y" * 6000 + slider, ""), (200, u, b"Just A Moment..." + page, ""), (200, u, b"z" * 3999 + b"just a moment...", ""),
        (200, u, b"document.cookie location.reload", ""), (200, u, b"document.cookie location.reload" + b" " * 1969, ""), (403, u, page, ""), (429, u, page, ""),
        (404, u, page, ""), (410, u, page, ""), (499, u, page, ""), (400, u, page, ""), (399, u, page, ""), (500, u, page, ""), (200, u, page, "image/png"),
        (200, "http://a.x/p.PDF", page, ""), (200, u, b"\n \t%PDF-1", ""), (200, u, b"\x89PNG", None), (200, u, b"", "text/plain"), (200, None, None, None),
    ]
    want = "ok captcha captcha captcha ok blocked ok blocked ok blocked blocked notfound notfound http4xx http4xx ok error nonhtml nonhtml nonhtml nonhtml ok ok".split()
    assert kinds(spark, rows) == want
    assert kinds(spark, rows, slider=False)[3] == "ok"


def test_strip_and_title(spark):
    df = spark.createDataFrame([("a<STYLE x>b</style>c<!-- d\n -->e<svg><p></svg><script>f</script><title>  T\nx </title>",)], "h string")
    r = df.select(C.strip_markup(F.col("h")).alias("s"), C.page_title(F.col("h")).alias("t")).first()
    assert r["s"] == "ace<script>f</script><title>  T\nx </title>" and r["t"] == "T\nx"


def test_store(spark):
    log = spark.createDataFrame(
        [("db", 1, "error", 1.0, 1, None), ("db", 1, "ok", 2.0, 2, None), ("db_cc", 1, "error", 3.0, 1, None), ("db", 2, "error", 1.0, 5, None), ("db", 3, "error", 1.0, 4, None), ("db", 3, "error", 1.0, 4, None)],
        "source string, id long, kind string, fetched_at double, attempts int, final_url string",
    )
    last = {(r["source"], r["id"]): r["kind"] for r in store.latest(log).collect()}
    assert last == {("db", 1): "ok", ("db_cc", 1): "error", ("db", 2): "error", ("db", 3): "error"}
    corpus = spark.createDataFrame([(i, "u") for i in range(1, 5)], "id long, url string")
    assert {(r["id"], r["attempts"]) for r in store.pending(corpus, log).collect()} == {(3, 4), (4, 0)}
    assert {r["id"] for r in store.done_ids(log).collect()} == {1, 2}


def test_captures(spark):
    m = spark.createDataFrame([(1, "2020", "a"), (1, "2020", "a"), (1, "2021", "b"), (1, "2021", "c"), (1, "2019", "d"), (2, "2020", "e")], "id long, ts string, original string")
    got = {(r["id"], r["rank"]): r["original"] for r in captures.newest(m, 3).collect()}
    assert got == {(1, 1): "c", (1, 2): "b", (1, 3): "a", (2, 1): "e"}
    cut = captures.before(m, {"h": "2020"}, F.lit("h"))
    assert {r["original"] for r in cut.collect()} == {"d"}
    best = {r["id"]: r["original"] for r in captures.first_accepted(captures.newest(m, 3), F.col("original") == "a").collect()}
    assert best == {1: "a", 2: None}
    rec = spark.createDataFrame([(1499,), (1500,), (None,)], "length long")
    assert captures.usable_records(rec).count() == 1


def test_ranges(spark):
    r = random.Random(3)
    keys = sorted({f"{a},{b})/{r.randint(0, 99):02d}" for a in "xyz" for b in "mno" for _ in range(9)})
    df = spark.createDataFrame([(k,) for k in keys], "key string").repartition(3)
    idx = ranges.blocks(df, size=4)
    blocks = sorted((x["block"], x["first_key"], x["next_key"]) for x in idx.collect())
    assert [b[1] for b in blocks] == keys[::4] and [b[2] for b in blocks] == [*keys[4::4], ranges.AFTER]
    prefixes = ["a)/", "x,m)/", "x,m)/5", "y,z)/", "zz)/", keys[8], "y,n)/", "z,", "y"]
    p = spark.createDataFrame([(x,) for x in prefixes], "prefix string")
    want = {b for b, f, n in blocks if any(f < q + ranges.AFTER and n > q for q in prefixes)}
    assert {x["block"] for x in ranges.overlapping(idx, p).collect()} == want
    pre = {x["probe"]: x["block"] for x in ranges.predecessor(idx, p.select(F.col("prefix").alias("probe"))).collect()}
    assert pre == {q: max((b for b, f, _ in blocks if f <= q), default=None) for q in prefixes}


def test_align(spark):
    gaps = {"p": [1, 2, 4, 7, 8, 11], "even": [0, 2, 4, 6, 8], "noise": [1, 2, 4, 7]}
    items = [("p", s, s in gaps["p"]) for s in range(0, 13)] + [("even", s, True) for s in range(0, 20, 2)] + [("noise", s, True) for s in gaps["noise"]] + [("none", 1, False)]
    ids = [("p", s - 30) for s in gaps["p"]] + [("even", s + 5) for s in gaps["even"]] + [("noise", s) for s in (3, 9, 10, 25)] + [("none", 7), ("lost", 1)]
    got = {r["book"]: r for r in align.align(spark.createDataFrame(items, "book string, si long, content boolean"), spark.createDataFrame(ids, "book string, new_id long")).collect()}
    assert (got["p"]["status"], got["p"]["shift"], got["p"]["stray"]) == ("aligned", -30, 0)
    assert got["even"]["status"] == "ambiguous" and got["noise"]["status"] == "rejected" and got["none"]["status"] == "rejected" and got["lost"]["status"] == "no index"


def test_shift_hits_against_all_pairs():
    import numpy as np

    r = random.Random(8)
    for _ in range(60):
        content = np.array(sorted(r.sample(range(-50, 200), r.randint(1, 60))))
        ids = np.array(sorted(r.sample(range(0, 300), r.randint(1, 60))))
        for span in (1 << 22, 0):
            align.MAX_SPAN, old = span, align.MAX_SPAN
            shifts, hits = align.shift_hits(content, ids)
            align.MAX_SPAN = old
            assert hits.tolist() == [sum(int(i - k) in set(content.tolist()) for i in ids) for k in shifts]


def test_windows_across_partitions(spark):
    """A key over many range partitions gives what one sequential pass gives."""
    r = random.Random(6)
    rows = [("hot" if r.random() < 0.8 else r.choice("ab"), i, r.random() < 0.93, r.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "h string, i int, f boolean, v int")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {x["i"]: x["run"] for x in windows.runs(df, ("h",), ("i",), F.col("f")).collect()}
        batch = {x["i"]: x["batch"] for x in windows.batches(df, ("i",), 7, ("h",)).collect()}
        share = {x["i"]: x["done_before"] for x in windows.running_share(df, ("h",), ("i",), "v").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    run, n, done = {}, {}, {}
    for h, i, f, v in rows:
        run[h] = run.get(h, 0) + 1 if f else 0
        assert got[i] == run[h] and batch[i] == n.get(h, 0) // 7 and share[i] == done.get(h, 0)
        n[h] = n.get(h, 0) + 1
        done[h] = done.get(h, 0) + v


def test_windows(spark):
    flags = [1] * 9 + [0] + [1] * 10 + [0] + [1] * 11
    df = spark.createDataFrame([("h", i, bool(f)) for i, f in enumerate(flags)], "h string, i int, f boolean")
    runs = [r["run"] for r in windows.runs(df, ("h",), ("i",), F.col("f")).orderBy("i").collect()]
    assert max(runs[:9]) == 9 and runs[9] == 0 and runs[19] == 10 and runs[-1] == 11
    b = [r["batch"] for r in windows.batches(df, ("i",), 10).orderBy("i").collect()]
    assert b == [i // 10 for i in range(len(flags))]
    d = spark.createDataFrame([("a", 0, 10), ("a", 10, 30), ("a", 10, 30)], "h string, t int, n int")
    assert [r["rate"] for r in windows.deltas(d, ("h",), "t", "n").orderBy("t").collect()] == [None, 2.0, None]


def test_states_add_up(spark):
    corpus = spark.createDataFrame([(i, "http://h/x", "h" if i < 6 else "r") for i in range(8)], "id long, url string, host string")
    log = spark.createDataFrame([(0, "db", "ok", "h"), (0, "db", "notfound", "h"), (1, "db", "notfound", "h"), (2, "db_cc", "notfound", "h"), (3, "db", "robots", "h"), (7, "db", "error", "r")], "id long, source string, kind string, host string")
    archived = spark.createDataFrame([(4,), (4,)], "id long")
    s = reports.page_states(corpus, log, archived, F.col("host") == "h", F.col("host") == "r")
    assert {r["id"]: r["state"] for r in s.collect()} == {0: "stored", 1: "dead", 2: "no_source", 3: "robots", 4: "queued_archive", 5: "no_source", 6: "robots", 7: "robots"}
    for r in reports.coverage(s).collect():
        assert r["total"] == sum(r[x] for x in reports.STATES)
    v = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", "y")], "k string, v string")
    assert {r["k"]: r["v"] for r in reports.main_value(v, "k", "v").collect()} == {"a": "x", "b": "y"}


def test_records(spark):
    raw = gzip.compress(b"WARC/1.0\r\nX: y\r\n\r\nHTTP/1.1 200 OK\r\ncontent-TYPE: text/html; a:b\r\n\r\nbody\r\n\r\nmore")
    df = spark.createDataFrame([(1, bytearray(raw)), (2, bytearray(b"no")), (3, None), (4, bytearray(gzip.compress(b"")))], "i int, raw binary")
    got = {r["i"]: (r["ctype"], bytes(r["body"]) if r["body"] is not None else None) for r in records.parse_records(df, "raw", "i").collect()}
    assert got == {1: (" text/html; a:b".strip(), b"body\r\n\r\nmore"), 2: (None, None), 3: (None, None), 4: ("", b"")}
    html = '<p><ul id="catalog-content"><li id="si3"><a href="/a/3.html">x</a><li id="si4">none<li id="si5"><a href="/quanben.html">y</a></ul>'
    e = records.catalog_entries(spark.createDataFrame([(7, html), (8, ""), (9, None)], "k int, h string"), "h", "k").collect()
    assert [tuple(x) for x in e] == [(7, 0, 3, "/a/3.html"), (7, 1, 4, None), (7, 2, 5, None)]
    rules = spark.createDataFrame([("User-agent: *\nCrawl-delay: 3\nDisallow: /no", "http://a/no/x"), ("User-agent: *\nDisallow: /no", "http://a/yes"), (None, "http://a/no")], "t string, u string")
    assert [(r["allowed"], r["crawl_delay"]) for r in records.robots_rules(rules, "t", "u").collect()] == [(False, 3.0), (True, None), (True, None)]
    text = spark.createDataFrame([('[{"id": "AB-2020-01", "x": 1}, {"id": "AB-2020"}, {"x": 2}]', "20200101 http://a b\r\nno\n2021 c"), ("no list", None)], "j string, l string")
    r = text.select(records.collections(F.col("j"), r"AB-\d{4}-\d{2}").alias("c"), records.listing_lines(F.col("l")).alias("l")).collect()
    assert r[0]["c"] == ["AB-2020-01"] and [tuple(x) for x in r[0]["l"]] == [("20200101", "http://a b"), ("2021", "c")] and r[1]["c"] == []


def test_files(spark, tmp_path):
    (tmp_path / "db").mkdir()
    with sqlite3.connect(tmp_path / "db" / "h.example.sqlite") as c:
        c.execute("CREATE TABLE pages (id INTEGER PRIMARY KEY, url TEXT, final_url TEXT, status INTEGER, kind TEXT, ctype TEXT, nbytes INTEGER, fetched_at REAL, attempts INTEGER, err TEXT, html BLOB)")
        c.execute("INSERT INTO pages VALUES (1,'u',NULL,200,'ok',NULL,5,1.5,1,NULL,X'00ff')")
        c.execute("INSERT INTO pages VALUES (2,'v',NULL,NULL,'error',NULL,0,2.5,1,'T',NULL)")
    from millrace.sources.sqlite import register

    register(spark)
    df = spark.read.format("sqlite_store").load(str(tmp_path))
    assert {(r["source"], r["host"], r["id"]) for r in df.collect()} == {("db", "h.example", 1), ("db", "h.example", 2)}
    assert [bytes(r["html"]) for r in df.where("kind = 'ok'").select("html").collect()] == [b"\x00\xff"]
    rows = [("20200101", 'a "b"\tc'), ("2020", None)]
    files.write_tsv(spark.createDataFrame(rows, "ts string, original string"), str(tmp_path / "t.cdx.tsv"))
    back = files.read_tsv(spark, str(tmp_path / "t.cdx.tsv"), files.CAPTURES)
    assert sorted((r["ts"], r["original"]) for r in back.collect()) == sorted(rows)
    (tmp_path / "s.json").write_text('{"updated": "x", "elapsed_min": 1.0, "groups": {"g": {"queue": 0, "rate": 1.0, "disabled": true, "strikes": 1, "paused_for": 0, "dead_hosts": ["a"]}}, "hosts": {"h": {"ok": 3}}}')
    assert files.status_groups(files.read_status(spark, str(tmp_path / "s.json"))).first()["shown"]
    (tmp_path / "bad.txt").write_bytes(b"a\xffb")
    assert files.read_lenient_text(spark, str(tmp_path / "bad.txt")).first()["text"] == "ab"
    assert files.read_listing(spark, str(tmp_path), "*.txt").first()["length"] == 3


class PlainLimiter:
    """One row after the other, for comparison."""

    def __init__(self):
        self.v = dict(strikes=0, paused_until=0.0, ok_streak=0, interval=0.5, disabled=False, errors=0, dead=False)

    def step(self, t, kind):
        v = self.v
        if kind == replay.BLOCK and t >= v["paused_until"]:
            if v["strikes"] == 8:
                v["disabled"] = True
            else:
                v.update(paused_until=t + replay.BLOCK_PAUSES[v["strikes"]], strikes=v["strikes"] + 1, ok_streak=0, interval=min(5.0, v["interval"] * 1.5))
        elif kind == replay.ERROR:
            v["errors"] += 1
            v["dead"] |= v["errors"] >= 60
        elif kind == replay.SUCCESS:
            v.update(errors=0, strikes=0, ok_streak=v["ok_streak"] + 1)
            if v["ok_streak"] >= 500 and v["interval"] > 0.5:
                v.update(ok_streak=0, interval=max(0.5, v["interval"] / 1.1))


class PlainThrottle:
    def __init__(self):
        self.v = dict(level=0, paused_until=0.0, ok_streak=0, rate=0.25)

    def step(self, t, kind):
        v = self.v
        if kind == replay.BLOCK and t >= v["paused_until"]:
            v.update(paused_until=t + replay.THROTTLE_PAUSES[min(v["level"], 3)], level=v["level"] + 1, ok_streak=0, rate=max(0.1, v["rate"] / 2))
        elif kind == replay.SUCCESS:
            v.update(level=0, ok_streak=v["ok_streak"] + 1)
            if v["ok_streak"] >= 300 and v["rate"] < 0.5:
                v.update(ok_streak=0, rate=min(0.5, v["rate"] * 1.1))


def test_folds_over_runs():
    import numpy as np

    r = random.Random(6)
    for plain, machine in ((PlainLimiter, replay.Limiter), (PlainThrottle, replay.Throttle)):
        for _ in range(60):
            kinds, t, at = [], 0.0, []
            for _ in range(r.randint(0, 25)):
                n = r.choice([1, 2, 3, 70, 400, 1300])
                kinds += [r.choice([replay.SUCCESS, replay.SUCCESS, replay.ERROR, replay.BLOCK])] * n
                for _ in range(n):
                    t += r.choice([0, 0, 1, 5, 400])
                    at.append(t)
            one = plain()
            for x, k in zip(at, kinds):
                one.step(x, k)
            state, cut = machine(), r.randint(0, len(kinds))
            for a, b in ((0, cut), (cut, len(kinds))):  # in two micro-batches
                state = state.fold(np.array(at[a:b]), np.array(kinds[a:b], np.int8))
            assert {k: float(x) for k, x in state._asdict().items()} == pytest.approx({k: float(x) for k, x in one.v.items()})
    assert replay.outcomes(["ok", None, "error", "captcha", "blocked"]).tolist() == [0, 0, 1, 2, 2]


def test_catalog():
    page = (
        '<li id="si1"><a href="/a.html">no</a></li><ul id="catalog-content"><li id="si1"><a href="/g.html" class="catalog_group">g</a><a href="/1.html">x</a></li>'
        '<li id="si2"><a href="/2_group.html">x</a><a href="/2.html">y</a><li id="six"><li id="si3">none<li id="si3"><p><a class=k href="/3.html">x</a></p></ul><a href="/z.html">z</a><li id="si4"><a href="4.html#a">f</a>'
    )
    assert records.parse_catalog(page) == [(1, "/1.html"), (2, None), (3, None), (3, "/3.html"), (4, None)]
    assert records.parse_catalog(None) == [] and records.parse_catalog("<li id=si1>") == []


def test_minute_counts(spark):
    t = datetime.datetime(2024, 1, 1, 0, 0, 30)
    df = spark.createDataFrame([(t, "a"), (t + datetime.timedelta(seconds=29), "a"), (t + datetime.timedelta(seconds=30), "a")], "ts timestamp, event_type string")
    assert sorted(r["n"] for r in replay.minute_counts(df).collect()) == [1, 2]


def test_keyed_sums_are_exact(spark):
    """Values that no double holds, and more keys than one level of blocks."""
    big = 2**53
    df = spark.range(0, 3000, 1, 5).select((F.col("id") % 700).cast("string").alias("k"), (F.col("id") * 3 + F.lit(big) * F.when(F.col("id") % 2 == 0, 1).otherwise(-1)).alias("v"))
    want = {r["k"]: (r["n"], r["s"]) for r in df.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()}
    assert {r["k"]: (r["n_rows"], r["s"]) for r in keyed_sums.keyed_sums(df, "k", {"s": F.col("v")}).collect()} == want
