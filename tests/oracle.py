"""Compares a registered query with its SQL over the same tables."""

import math
import os

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    return v


def run_sql(sql: str, sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return names, cur.fetchall()


def same(df, sql: str, sf: str) -> None:
    names, want = run_sql(sql, sf)
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    order = sorted(names)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in want), key=repr)
    assert len(got) == len(want), (len(got), len(want))
    for g, w in zip(got, want, strict=True):
        assert g == w, (order, g, w)
