"""Run registered queries and compare them with their SQL in DuckDB."""
from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in data)


def differences(spark, sf_dir: str, fn, sql: str, con=None) -> list[str]:
    con = con or connect(sf_dir)
    df = fn(spark, sf_dir)
    got = rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows(names, cur.fetchall())
    out = []
    if sorted(names) != sorted(df.columns):
        out.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if got != want:
        out.append(f"{sum(got.values())} rows vs {sum(want.values())}; extra {list((got - want).items())[:2]}; missing {list((want - got).items())[:2]}")
    return out
