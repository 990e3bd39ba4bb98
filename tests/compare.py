"""Run a registered query and its SQL twin over the same tables and compare them."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides hold the same rows under the same column names."""
    cur = con.execute(sql)
    names, expected = [d[0] for d in cur.description], cur.fetchall()
    got = [tuple(r) for r in spark_df.collect()]
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for a, b in zip(_rows(spark_df.columns, got), _rows(names, expected)):
        if a != b:
            return f"{a} != {b}"
    return None
