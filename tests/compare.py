"""Run a query and its SQL counterpart and compare them row by row."""

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
               "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _value(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (datetime.datetime, datetime.date, decimal.Decimal)):
        return str(v)
    return v


def difference(df, db, sql):
    """None where both agree on column names, types and the bag of rows."""
    relation = db.sql(sql)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    ours = {name: _TYPE_NAMES.get(kind, kind) for name, kind in df.dtypes}
    if ours != theirs:
        return f"schema: {ours} against {theirs}"
    names = sorted(ours)
    left = Counter(tuple(_value(r[n]) for n in names) for r in df.collect())
    positions = [relation.columns.index(n) for n in names]
    right = Counter(tuple(_value(r[p]) for p in positions) for r in relation.fetchall())
    if left != right:
        return (
            f"{sum(left.values())} rows against {sum(right.values())}; "
            f"extra {list((left - right).items())[:3]}, missing {list((right - left).items())[:3]}"
        )
    return None
