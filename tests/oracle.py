"""Comparing a query with its SQL on DuckDB."""

import os

import duckdb

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf):
    con = duckdb.connect()
    for name in NAMES:
        path = f"{sf}/{name}.parquet"
        con.sql(f"create view {name} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def cells(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def assert_same(df, sql, sf):
    rel = connection(sf).sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    assert cells([tuple(r) for r in df.collect()], df.columns) == cells(rel.fetchall(), rel.columns)
