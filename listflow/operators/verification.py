"""Agreement between merged events and what their sources state when read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import price, text

_TIMES_WITHIN_SECONDS = 15 * 60


def source_tier(source: Column) -> Column:
    pairs = [F.lit(x) for item in K.SOURCE_TIERS.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), source), F.lit("aggregator"))


def _date_agrees(stated: Column, canonical: Column) -> Column:
    untimed = F.date_format(stated, "HH:mm:ss") == "00:00:00"
    close = F.abs(F.timestamp_diff("SECOND", stated, canonical)) <= _TIMES_WITHIN_SECONDS
    same = (F.to_date(stated) == F.to_date(canonical)) & (untimed | close)
    return F.when(stated.isNotNull(), F.coalesce(same, F.lit(False)))


def _venue_agrees(venue: Column, address: Column, own_venue: Column, own_address: Column) -> Column:
    v, s = text.venue_key(venue), text.street_key(address)
    same_venue = F.when(v.isNotNull(), F.coalesce(v == text.venue_key(own_venue), F.lit(False)))
    same_street = F.when(s.isNotNull(), F.coalesce(s == text.street_key(own_address), F.lit(False)))
    both = F.coalesce(same_venue, F.lit(True)) & F.coalesce(same_street, F.lit(True))
    return F.when(v.isNotNull() | s.isNotNull(), both)


def cross_check(events: DataFrame, observations: DataFrame) -> DataFrame:
    """Every observed source row with its agreement per field; null = the field is not stated.

    ``events`` (event_id, start_dt, venue_name, venue_address, price, primary_source).
    """
    canon = events.select("event_id", F.col("start_dt").alias("_start"),
                          F.col("venue_name").alias("_venue"),
                          F.col("venue_address").alias("_address"),
                          F.col("price").alias("_price"), "primary_source")
    address = (F.col("stated_address") if "stated_address" in observations.columns
               else F.lit(None).cast("string"))
    ok = F.coalesce(F.col("fetch_ok"), F.lit(False))
    rows = observations.join(canon, "event_id").withColumns({
        "date_ok": F.when(ok, _date_agrees(F.col("stated_start"), F.col("_start"))),
        "venue_ok": F.when(ok, _venue_agrees(
            F.col("stated_venue"), address, F.col("_venue"), F.col("_address"))),
        "price_ok": F.when(ok & ~text.is_blank(F.col("stated_price")),
                           price.price_agrees(F.col("stated_price"), F.col("_price"))),
    })
    fields = ("date_ok", "venue_ok", "price_ok")
    stated = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    agreed = F.lit(True)
    for f in fields:
        agreed = agreed & F.coalesce(F.col(f), F.lit(True))
    return (
        rows.withColumn("n_stated", stated)
        .withColumn("corroborates", ok & (stated >= 2) & agreed)
        .withColumn("is_primary", F.col("source") == F.col("primary_source"))
        .drop("_start", "_venue", "_address", "_price")
    )


def verification_verdict(checked: DataFrame, events: DataFrame) -> DataFrame:
    """One verdict for each of ``events`` from :func:`cross_check` rows, in one aggregate.

    An event that nobody observed, or whose primary source was not read, is held.
    """
    authority = F.col("corroborates") & source_tier(F.col("source")).isin(
        *K.SINGLE_SOURCE_TIERS) & (F.col("n_stated") == 3)
    agree = lambda c: F.coalesce(F.bool_and(c), F.lit(False))
    per = checked.groupBy("event_id").agg(
        agree("date_ok").alias("date_agrees"),
        agree("venue_ok").alias("venue_agrees"),
        agree("price_ok").alias("price_agrees"),
        F.count("*").alias("n_sources"),
        F.count_if("corroborates").alias("n_corroborating"),
        F.count_if(authority).alias("_authority"),
        F.count_if(F.col("is_primary") & F.coalesce(F.col("fetch_ok"), F.lit(False))).alias("_primary"),
        F.count_if(F.col("status_flag").isNotNull()
                   | F.col("is_primary") & ~F.coalesce(F.col("fetch_ok"), F.lit(False))).alias("_stop"))
    enough = (F.col("n_corroborating") >= 2) | (
        (F.col("n_corroborating") == 1) & (F.col("_authority") == 1))
    good = (F.col("date_agrees") & F.col("venue_agrees") & F.col("price_agrees") & enough
            & (F.col("_stop") == 0) & (F.col("_primary") > 0))
    every = events.select("event_id").distinct().join(per, "event_id", "left")
    every = every.fillna(False, ["date_agrees", "venue_agrees", "price_agrees"]).fillna(0, ["n_sources", "n_corroborating"])
    return every.withColumn("verdict", F.when(good, "VERIFIED").otherwise("HELD")).drop(
        "_authority", "_primary", "_stop")
