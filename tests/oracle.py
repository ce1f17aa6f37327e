"""Spark's rows against DuckDB's, column by column name, as multisets."""

import datetime
import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        db.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{source}')")
    return db


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), Counter(tuple(plain(r[k]) for k in order) for r in rows)


def compare(df, db, sql):
    """None if equal, else what differs."""
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = db.execute(sql)
    want_columns, want = rows_of([c[0] for c in found.description], found.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} and {want_columns}"
    if got != want:
        return f"{sum(got.values())} and {sum(want.values())} rows; only Spark {list((got - want).items())[:3]}; only SQL {list((want - got).items())[:3]}"
    return None
