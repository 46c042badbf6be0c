"""A query's rows against those of its SQL, without order."""

import datetime
import decimal
import math
import os

import duckdb


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, list):
        return tuple(plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def connection(folder):
    c = duckdb.connect()
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            c.execute(f"create view {f[:-8]} as select * from '{folder}/{f}'")
    return c


def difference(df, c, sql):
    """None, or what differs."""
    r = c.execute(sql)
    rows, names = r.fetchall(), [d[0] for d in r.description]
    order = sorted(df.columns)
    if order != sorted(names):
        return f"columns {order} and {sorted(names)}"
    a = sorted((tuple(plain(x[k]) for k in order) for x in df.collect()), key=repr)
    b = sorted((tuple(plain(x[names.index(k)]) for k in order) for x in rows), key=repr)
    if a != b:
        return f"{len(a)} and {len(b)} rows; {sorted(set(map(repr, a)) - set(map(repr, b)))[:2]} and {sorted(set(map(repr, b)) - set(map(repr, a)))[:2]}"
    return None
