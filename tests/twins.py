"""Holds a query's rows against its DuckDB twin."""

import datetime
import glob
import math
from collections import Counter

import duckdb


def _plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, sql: str, sf_dir: str) -> list:
    """Up to three rows of either side that the other lacks; columns, if they differ."""
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = path.rsplit("/", 1)[1].removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    found = con.execute(sql)
    columns, theirs = _bag([c[0] for c in found.description], found.fetchall())
    ours_columns, ours = _bag(df.columns, [tuple(r) for r in df.collect()])
    if columns != ours_columns:
        return [ours_columns, columns]
    return [*list((ours - theirs).elements())[:3], *list((theirs - ours).elements())[:3]]
