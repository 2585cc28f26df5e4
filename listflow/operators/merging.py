"""Field survivorship over resolved groups, and its invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import keys, price, text
from listflow.operators.changes import source_priority
from listflow.operators.ranking import rank_within


def _specificity(field: str) -> Column:
    c = F.col(field)
    if field == "start_dt":
        return F.when(F.date_format(c, "HH:mm:ss") != "00:00:00", 1).otherwise(0)
    if field == "venue_address":
        return F.length(c)
    if field == "price":
        return price.price_specificity(c)
    return F.lit(0)


def _stated(members: DataFrame, field: str) -> Column:
    c = F.col(field)
    return c.isNotNull() if dict(members.dtypes)[field] != "string" else ~text.is_blank(c)


def _tier(members: DataFrame) -> Column:
    return source_priority(F.col("source"), F.col("url") if "url" in members.columns else None)


def _contender(members: DataFrame, field: str) -> Column:
    """Sort key then payload of one member's value; null when it states none."""
    return F.when(_stated(members, field), F.struct(
        _tier(members).alias("tier"),
        (-_specificity(field)).alias("spec"),
        F.col("pos").alias("pos"),
        F.col(field).alias("value"),
        F.col("source").alias("source"),
        F.col("member_id").alias("member_id")))


def field_rank(members: DataFrame, field: str) -> DataFrame:
    """Contenders for one field with their rank inside the group, best first."""
    stated = members.filter(_stated(members, field))
    ranked = rank_within(stated, "group_id", [
        _tier(members), -_specificity(field), F.col("pos")])
    return ranked.select("group_id", "member_id", F.col(field).alias("value"), "rank")


def survivorship(members: DataFrame, fields: tuple[str, ...] = K.CANONICAL_FIELDS) -> DataFrame:
    """One row per group: the best value of every field, copied verbatim, and its source.

    ``members`` holds (group_id, member_id, source, pos, fields). Each field is one ``min`` over
    an ordered struct, so the whole merge is a single partial-then-final aggregate and a large
    group never gathers in one place. ``provenance`` has an entry per field that has a value.
    """
    best = members.groupBy("group_id").agg(
        *[F.min(_contender(members, f)).alias(f"_{f}") for f in fields])
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_{f}.source").alias("source"))
                        for f in fields])
    givers = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_{f}.member_id").alias("id"))
                       for f in fields])
    return best.select(
        "group_id",
        *[F.col(f"_{f}.value").alias(f) for f in fields],
        F.map_from_entries(F.filter(entries, lambda e: e["source"].isNotNull())).alias("provenance"),
        F.map_from_entries(F.filter(givers, lambda e: e["id"].isNotNull())).alias("givers"),
    )


def group_summary(members: DataFrame) -> DataFrame:
    """Member count, distinct sources and best relevance (0 when unscored) per group.

    Membership itself stays a table (group_id, member_id); it is not gathered into an array.
    """
    return members.groupBy("group_id").agg(
        F.count("*").alias("n_members"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.coalesce(F.max("relevance_avg"), F.lit(0.0)).alias("best_relevance"))


def canonical_events(members: DataFrame) -> DataFrame:
    """Merged events with their id, hash, provenance and summary."""
    merged = survivorship(members).join(group_summary(members), "group_id")
    return merged.withColumns({
        "event_id": keys.canonical_id(F.col("title"), F.col("start_dt"), F.col("venue_name")),
        "content_hash": keys.content_hash(F.col("start_dt"), F.col("venue_name"), F.col("price")),
    })


def merge_invariants(inputs: DataFrame, members: DataFrame, merged: DataFrame,
                     fields: tuple[str, ...] = K.CANONICAL_FIELDS) -> DataFrame:
    """Violations per rule, all zero for a sound merge.

    ``inputs`` (member_id, fields), ``members`` (member_id, group_id), ``merged`` as
    :func:`survivorship` returns it.
    """
    given = inputs.select("member_id")
    placed = members.select("member_id", "group_id")
    count = lambda name, df: df.agg(F.lit(name).alias("rule"), F.count("*").alias("violations"))
    twice = placed.groupBy("member_id").agg(F.count("*").alias("n")).filter("n > 1")
    stated = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in fields]))
    keyset = F.array_sort(F.map_keys("provenance"))
    odd = merged.filter(~keyset.eqNullSafe(F.array_sort(stated)))
    claimed = merged.select(
        "group_id", F.explode(F.array(*[F.struct(
            F.lit(f).alias("field"), F.col(f).cast("string").alias("value"),
            F.try_element_at("givers", F.lit(f)).alias("member_id")) for f in fields])).alias("c")
    ).select("group_id", "c.*").filter("value is not null")
    said = inputs.select("member_id", *[F.col(f).cast("string").alias(f"in_{f}") for f in fields])
    original = F.coalesce(*[F.when(F.col("field") == f, F.col(f"in_{f}")) for f in fields])
    altered = claimed.join(said, "member_id", "left").filter(
        ~original.eqNullSafe(F.col("value")))
    out = count("missing", given.exceptAll(placed.select("member_id")))
    for name, df in (("added", placed.select("member_id").exceptAll(given)), ("twice", twice),
                     ("provenance_keys", odd), ("altered_values", altered)):
        out = out.unionByName(count(name, df))
    return out
