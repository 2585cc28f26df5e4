"""Side-by-side comparison of a Spark result and its DuckDB oracle."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from listflow.checks.fixtures import BASE


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a description of the difference."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = _rows(names, cur.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns differ: spark {sorted(df.columns)} duckdb {sorted(names)}"
    if not want:
        return "oracle returned no rows"
    if got != want:
        missing, extra = want - got, got - want
        return (f"spark {sum(got.values())} rows, duckdb {sum(want.values())}; "
                f"missing {sum(missing.values())} e.g. {list(missing)[:3]}; "
                f"extra {sum(extra.values())} e.g. {list(extra)[:3]}")
    return None
