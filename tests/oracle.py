"""Holds a Spark result against DuckDB SQL over the same tables, order aside."""

import datetime
import decimal
import math
import os

import duckdb

from millrace.session import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((repr([plain(r[i]) for i in order]) for r in rows))


def assert_same(df, con, sql):
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    a, b = rows_of(df.columns, got), rows_of(names, cur.fetchall())
    assert len(a) == len(b), (len(a), len(b))
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    assert not wrong, (len(wrong), sorted(names), wrong[:3])
