"""Comparison of a query with its SQL twin."""

import glob
import os

import duckdb


def connection(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def same(df, con, sql):
    cols = df.columns
    got = sorted(repr(tuple(plain(v) for v in r)) for r in df.collect())
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    assert sorted(names) == sorted(cols)
    at = [names.index(c) for c in cols]
    want = sorted(repr(tuple(plain(r[i]) for i in at)) for r in res.fetchall())
    assert got == want
