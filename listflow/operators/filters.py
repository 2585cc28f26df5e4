"""Projections, filters and predicates over listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import dates, geo, text
from listflow.functions.binding import let


def normalize_listing(df: DataFrame) -> DataFrame:
    """Conform text fields: collapsed whitespace, blanks null, required strings never null."""
    url = F.regexp_replace(F.coalesce(df["url"], F.lit("")), r"(?U)^\s+|\s+$", "")
    changed = {
        "source_id": F.coalesce(text.clean_text(df["source_id"]), url),
        "url": url,
        "title": F.coalesce(text.clean_text(df["title"]), F.lit("")),
        "description": F.coalesce(text.clean_text(df["description"]), F.lit("")),
    }
    for c in ("venue_name", "venue_address", "price", "register_url", "image_url"):
        changed[c] = text.clean_text(df[c])
    return df.withColumns(changed)


def valid_listing(df: DataFrame) -> DataFrame:
    """Keep rows that carry a url and a title; the key set itself is a schema check."""
    missing = [k for k in K.LISTING_KEYS if k != "raw" and k not in df.columns]
    if missing:
        raise ValueError(f"not a listing table, missing {missing}")
    return df.filter((F.coalesce(F.col("url"), F.lit("")) != "")
                     & (F.coalesce(F.col("title"), F.lit("")) != ""))


def dedupe_same_source(df: DataFrame, order: str = "pos") -> DataFrame:
    """First record per (source, source_id or url) in input order.

    The rank filter becomes a per-partition limit before the shuffle, so a hot key sends one
    row per task.
    """
    key = F.coalesce(F.nullif(F.col("source_id"), F.lit("")), F.col("url"))
    w = Window.partitionBy("source", key).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def collect_window(df: DataFrame, as_of: str, days: int = 10,
                   include_undated: bool = True) -> DataFrame:
    """Keep starts from today's midnight through the end of the last day."""
    lower = dates.midnight(dates.as_ntz(as_of))
    upper = lower + F.make_dt_interval(F.lit(max(0, days) + 1))
    inside = (F.col("start_dt") >= lower) & (F.col("start_dt") < upper)
    return df.filter(inside | F.col("start_dt").isNull() if include_undated else inside)


def in_lead(start: Column, as_of: str, min_days: int = 0, max_days: int = 10) -> Column:
    now = dates.as_ntz(as_of)
    return start.between(now + F.make_dt_interval(F.lit(min_days)),
                         now + F.make_dt_interval(F.lit(max_days)))


def lead_window(df: DataFrame, as_of: str, min_days: int = 0, max_days: int = 10) -> DataFrame:
    """Keep dated rows whose lead time is within the bounds, both inclusive."""
    return df.filter(in_lead(F.col("start_dt"), as_of, min_days, max_days))


def keyword_columns(title: Column, description: Column, lexicon: dict[str, list[str]],
                    excludes: list[str], mode: str = "substring") -> tuple[Column, Column]:
    """(excluded, array of matched group names) for the folded title and description."""
    hit = text.contains_any if mode == "substring" else text.contains_any_word
    hay = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "),
                           F.coalesce(description, F.lit(""))))
    groups = lambda h: F.array_compact(F.array(*[
        F.when(hit(h, terms), F.lit(name)) for name, terms in lexicon.items()]))
    return let(hay, lambda h: hit(h, excludes)), let(hay, groups)


def keyword_filter(df: DataFrame, lexicon: dict[str, list[str]] | None = None,
                   excludes: list[str] | None = None, mode: str = "substring") -> DataFrame:
    """Keep rows with an include term and no exclude term; adds ``keyword_groups``."""
    excluded, groups = keyword_columns(
        F.col("title"), F.col("description"), lexicon or K.KEYWORDS,
        K.KEYWORD_EXCLUDES if excludes is None else excludes, mode)
    # a generator keeps the filter from matching every term once more
    return df.withColumn("keyword_groups", F.explode(F.filter(
        F.array(F.when(~excluded, groups)), lambda g: F.size(g) > 0)))


def relevance_columns(df: DataFrame, pass_avg: float = K.RELEVANCE_PASS) -> DataFrame:
    total = F.col("category_fit") + F.col("audience_fit") + F.col("timeliness")
    df = df.withColumn("relevance_avg", F.round(total / 3.0, 2).cast("double"))
    return df.withColumn("qualified", F.coalesce(
        (F.col("relevance_avg") >= pass_avg) & F.col("pass_flag"), F.lit(False)))


def relevance_gate(df: DataFrame, pass_avg: float = K.RELEVANCE_PASS) -> DataFrame:
    """Keep rows whose three-factor average and flag both pass."""
    return relevance_columns(df, pass_avg).filter("qualified").drop("qualified")


def timeliness_band(df: DataFrame, as_of: str) -> DataFrame:
    """Score range that the date alone allows, as ``band_low`` and ``band_high``."""
    out = F.datediff(F.col("start_dt"), dates.as_ntz(as_of))
    past = F.col("start_dt") < dates.as_ntz(as_of)
    low = (F.when(out.isNull() | past | (out <= 1) | (out > 45), 1)
           .when(out.between(7, 10), 9)
           .when(out.between(5, 6) | out.between(11, 14), 7)
           .otherwise(4))
    df = df.withColumn("days_out", out).withColumn("band_low", low)
    high = F.when(F.col("band_low") == 9, 10).when(F.col("band_low") == 7, 8).when(
        F.col("band_low") == 4, 6).otherwise(3)
    return df.withColumn("band_high", high)


def too_late(start: Column, as_of: str, floor_days: int = 2) -> Column:
    floor = dates.as_ntz(as_of) + F.make_dt_interval(F.lit(floor_days))
    return F.coalesce(start < floor, F.lit(False))


def drop_too_late(df: DataFrame, as_of: str, floor_days: int = 2) -> DataFrame:
    """Drop rows with less lead than the floor; undated rows are never too late."""
    return df.filter(~too_late(F.col("start_dt"), as_of, floor_days))


def in_bounds(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Keep coordinates inside the accepted box, rounded to six places."""
    return (df.filter(geo.in_bounds(F.col(lat), F.col(lon)))
            .withColumn(lat, F.round(lat, 6)).withColumn(lon, F.round(lon, 6)))


def payload_view(events: DataFrame) -> DataFrame:
    """Hand-off rows: an event struct without serialized columns, next to the parsed ones."""
    parsed = ("provenance", "sources", "transit")
    plain = [c for c in events.columns if not c.endswith("_json") and c not in parsed]
    kept = [c for c in parsed if c in events.columns]
    return events.select(F.struct(*plain).alias("event"), *kept)
