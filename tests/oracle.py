"""Compare a Spark result with its SQL check, as multisets of rows over name-sorted columns."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def difference(df, con, sql: str) -> str | None:
    names = sorted(df.columns)
    got = Counter(tuple(plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    cursor = con.execute(sql)
    labels = [c[0] for c in cursor.description]
    if sorted(labels) != names:
        return f"columns {names} against {sorted(labels)}"
    at = [labels.index(n) for n in names]
    want = Counter(tuple(plain(row[i]) for i in at) for row in cursor.fetchall())
    if got == want:
        return None
    missing, extra = list((want - got).items())[:2], list((got - want).items())[:2]
    return f"{sum(got.values())} rows against {sum(want.values())}\n  only SQL: {missing}\n  only Spark: {extra}"
