"""Runs a registered query and its SQL and compares the rows."""

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


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return v.isoformat()[:26] if hasattr(v, "isoformat") else repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def assert_same(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = connect(sf_dir).execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, got.fetchall())
