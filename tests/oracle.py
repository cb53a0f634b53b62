"""Side-by-side comparison of a query and its SQL counterpart."""

import glob
import os

import duckdb


def views(d):
    c = duckdb.connect()
    for f in glob.glob(d + "/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


def assert_same(df, con, sql):
    cols = sorted(df.columns)
    mine = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    at = [list(rel.columns).index(c) for c in cols]
    theirs = sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
    assert mine == theirs
