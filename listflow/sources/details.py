"""Topping up undated listings from their detail pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.operators import ranking

_FILLED = [k for k in K.LISTING_KEYS if k not in ("source", "source_id", "url", "raw")]


def detail_budget(listings: DataFrame, budget: int = K.DETAIL_BUDGET) -> DataFrame:
    """The first undated listings of every site, the ones whose detail page is read."""
    w = Window.partitionBy("source").orderBy("pos")
    undated = listings.filter("start_dt is null and coalesce(url, '') <> ''")
    return undated.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= budget).drop("_rn")


def topup_from_detail(listings: DataFrame, details: DataFrame,
                      budget: int | None = None) -> DataFrame:
    """Fill empty fields of undated listings; identity and filled fields never change.

    With a ``budget``, only the first so many of every source are filled.

    ``details`` holds extracted rows by url, of which one counts, with ``og_description`` as a last resort for
    the description. When both sides carry ``raw`` as a map, the listing's entries win.
    """
    fields = [f for f in _FILLED if f in listings.columns and f in details.columns]
    has_raw = all("raw" in d.columns and dict(d.dtypes)["raw"].startswith("map") for d in (listings, details))
    og = F.col("og_description") if "og_description" in details.columns else F.lit(None).cast("string")
    found = ranking.one_per_key(details, "url").select(
        F.col("url").alias("_url"), *[F.col(f).alias(f"_d_{f}") for f in fields],
        og.alias("_og"), *([F.col("raw").alias("_d_raw")] if has_raw else []))
    undated = listings.filter("start_dt is null and coalesce(url, '') <> ''")
    chosen = (undated if budget is None else detail_budget(listings, budget)).select("source", "pos", F.lit(True).alias("_read"))
    j = listings.join(chosen, ["source", "pos"], "left").join(
        found, F.col("_read") & (F.col("url") == F.col("_url")), "left")
    empty = lambda c: c.isNull() | (c.cast("string") == "")
    filled = {f: F.when(empty(F.col(f)), F.coalesce(F.col(f"_d_{f}"), F.col(f))).otherwise(F.col(f)) for f in fields}
    if "description" in listings.columns:
        now = filled.get("description", F.col("description"))
        filled["description"] = F.when(empty(now), F.coalesce(F.col("_og"), now)).otherwise(now)
    if has_raw:
        filled["raw"] = F.when(F.col("_d_raw").isNotNull(), F.map_zip_with(
            F.coalesce("raw", F.create_map().cast("map<string,string>")), F.col("_d_raw"),
            lambda k, own, other: F.coalesce(own, other))).otherwise(F.col("raw"))
    return j.withColumns(filled).select(*listings.columns)
