"""Landed listings: reading, union, coverage and snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import dates

#: Types of the contract columns; a landed table may lack any of them.
LISTING_TYPES = {
    **{k: "string" for k in K.LISTING_KEYS},
    "start_dt": "timestamp_ntz",
    "end_dt": "timestamp_ntz",
}


def conform(df: DataFrame) -> DataFrame:
    """Add missing contract columns as null; other columns are kept behind them.

    Times become Pacific wall-clock: a zone or offset in the text, and an instant, are converted.
    """
    kinds = dict(df.dtypes)

    def read(k: str, t: str) -> Column:
        if k not in kinds:
            return F.lit(None).cast(t)
        return dates.wall_clock(F.col(k), kinds[k]) if t == "timestamp_ntz" else F.col(k).cast(t)

    contract = [read(k, t).alias(k) for k, t in LISTING_TYPES.items()]
    return df.select(*contract, *[c for c in df.columns if c not in LISTING_TYPES])


def read_listings(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: str | None = None) -> DataFrame:
    """Landed listings conformed to the contract."""
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    return conform(reader.load(path))


def union_sources(*frames: DataFrame) -> DataFrame:
    """All adapters' listings in one table; columns an adapter lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def source_coverage(listings: DataFrame, expected: DataFrame) -> DataFrame:
    """Listing count per expected source and whether it produced nothing.

    ``expected`` holds (source, enabled). ``all_silent`` marks a total outage, which must not
    read as a quiet week.
    """
    counts = listings.groupBy("source").agg(F.count("*").alias("n"))
    per = expected.filter("enabled").join(counts, "source", "left").select(
        "source", F.coalesce("n", F.lit(0)).alias("n_listings"))
    total = per.agg(F.sum("n_listings")).scalar()
    return per.withColumn("silent", F.col("n_listings") == 0).withColumn("all_silent", total == 0)


def require_listings(coverage: DataFrame) -> DataFrame:
    """The coverage itself, or an error when every expected source was silent."""
    if coverage.filter("not silent").isEmpty():
        raise ValueError("no expected source produced a listing")
    return coverage


def write_snapshot(df: DataFrame, path: str, run_id: str) -> str:
    """Write one run's version of a table and return its folder.

    A new folder per run keeps the previous version whole until the new one is complete.
    """
    target = f"{path.rstrip('/')}/run_id={run_id}"
    df.write.mode("overwrite").parquet(target)
    return target
