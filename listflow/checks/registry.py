"""Registry of checked queries: name -> (query over the tables, DuckDB oracle or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listflow.checks.fixtures import Tables, oracle

_QUERIES: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query under its inventory name, with its oracle body and the views it reads."""

    def keep(fn):
        _QUERIES[name] = (fn, oracle(sql, *views) if sql else None)
        return fn

    return keep


def printable(df: DataFrame) -> DataFrame:
    """Wall-clock columns as text, so both engines return the same type."""
    texts = {c: F.col(c).cast("string") for c, t in df.dtypes if t in ("timestamp_ntz", "date")}
    return df.withColumns(texts) if texts else df


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: printable(fn(Tables(spark, sf_dir)))

    return {name: bind(fn) for name, (fn, _) in _QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
