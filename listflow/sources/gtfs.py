"""Unpacked GTFS feeds: one folder per feed holding its CSV members."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns read from each member; everything else stays unread.
MEMBERS = {
    "routes": ["route_id", "route_short_name", "route_long_name", "route_type"],
    "trips": ["trip_id", "route_id"],
    "stop_times": ["trip_id", "stop_id"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
}
REQUIRED = {"stop_times": ["trip_id", "stop_id"]}


def read_member(spark: SparkSession, path: str, member: str, feed: str) -> DataFrame:
    """One member of one feed with trimmed, lowercased headers and no byte-order mark."""
    raw = spark.read.csv(path, header=True, encoding="UTF-8")
    names = {c.replace("﻿", "").strip().lower(): c for c in raw.columns}
    missing = [c for c in REQUIRED.get(member, []) if c not in names]
    if missing:
        raise ValueError(f"{member} of feed {feed} lacks {missing}")
    return raw.select(
        F.lit(feed).alias("feed"),
        *[(F.col(f"`{names[c]}`") if c in names else F.lit(None).cast("string")).alias(c)
          for c in MEMBERS[member]])


def gtfs_read(spark: SparkSession, feeds: dict[str, str]) -> dict[str, DataFrame]:
    """All feeds' members as four tables. ``feeds`` maps a feed name to its folder."""
    return {
        member: reduce(DataFrame.unionByName, [
            read_member(spark, f"{folder}/{member}.txt", member, feed)
            for feed, folder in feeds.items()])
        for member in MEMBERS
    }
