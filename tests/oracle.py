"""Runs a query and its SQL over the same small tables and compares the rows."""

import math
import os

DATA = "/root/testdata/sf0.001"


def views():
    import duckdb

    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for f in sorted(os.listdir(DATA)):
        c.sql(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return c


def plain(rows, columns):
    def value(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return None
        return float(x) if isinstance(x, float) else x

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def same(spark, query, sql):
    df = query(spark, DATA)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    rel = views().sql(sql)
    want = plain(rel.fetchall(), rel.columns)
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == want
