"""Compares a query with its SQL."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.replace(tzinfo=None) if getattr(v, "tzinfo", None) is not None else v


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def assert_same(df, con, sql):
    names = sorted(df.columns)
    got = ordered(tuple(value(r[c]) for c in names) for r in df.collect())
    cur = con.execute(sql)
    found = [d[0] for d in cur.description]
    assert sorted(found) == names
    want = ordered(tuple(value(r[found.index(c)]) for c in names) for r in cur.fetchall())
    assert len(got) == len(want)
    assert next(((g, w) for g, w in zip(got, want, strict=True) if g != w), None) is None
