"""Row-by-row comparison of a query with its SQL."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") + 0.0
    return v


def compare(spark: SparkSession, sf: str, fn, sql: str | None) -> str:
    """``ok ...`` or a description of the difference."""
    df = fn(spark, sf)
    names = sorted(df.columns)
    got = [tuple(_plain(row[n]) for n in names) for row in df.collect()]
    if sql is None:
        return f"ok (rows only) {len(got)}"
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(sql)
    header = [d[0] for d in cur.description]
    if sorted(header) != names:
        return f"columns {sorted(header)} against {names}"
    order = [header.index(n) for n in names]
    want = [tuple(_plain(row[i]) for i in order) for row in cur.fetchall()]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    spark_kinds = dict(df.dtypes)
    pairs = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [f"{n}: {spark_kinds[n]} against {kinds[n]}" for n in names if pairs.get(spark_kinds[n]) != kinds[n]]
    a, b = Counter(got), Counter(want)
    if a != b:
        return f"{len(got)} rows against {len(want)}; only Spark {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
    missing = sum(v is None for row in got for v in row)
    note = f" types {odd}" if odd else ""
    return f"{'types differ' if odd else 'ok'} {len(got)} rows, {missing} missing cells{note}"
