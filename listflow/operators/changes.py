"""Change detection against the fingerprint state, and the state's own merges.

Merges are pure: ``(current, updates) -> new``; the caller writes the new snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import dates, keys, urls
from listflow.functions.binding import let
from listflow.operators import filters


def with_keys(listings: DataFrame) -> DataFrame:
    """Add ``fingerprint`` and ``content_hash``."""
    return listings.withColumns({
        "fingerprint": keys.fingerprint(F.col("source"), F.col("source_id")),
        "content_hash": keys.content_hash(
            F.col("start_dt"), F.col("venue_name"), F.col("price")),
    })


def classify_changes(listings: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Add ``change``: new, changed or unchanged against the state."""
    known = fingerprints.select("fingerprint", F.col("content_hash").alias("_known"))
    df = listings if "fingerprint" in listings.columns else with_keys(listings)
    return (
        df.join(known, "fingerprint", "left")
        .withColumn("change", F.when(F.col("_known").isNull(), "new")
                    .when(F.col("_known") != F.col("content_hash"), "changed")
                    .otherwise("unchanged"))
        .drop("_known")
    )


def change_filter(listings: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Only new and changed listings."""
    return classify_changes(listings, fingerprints).filter("change <> 'unchanged'")


def latest_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key, the first in the given order."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def refresh_seen(fingerprints: DataFrame, classified: DataFrame, as_of: str) -> DataFrame:
    """Move ``last_seen`` of fingerprints whose record came back unchanged."""
    same = classified.filter("change = 'unchanged'").select("fingerprint").distinct()
    marked = fingerprints.join(same.withColumn("_same", F.lit(True)), "fingerprint", "left")
    return marked.withColumn(
        "last_seen", F.when(F.col("_same"), dates.as_ntz(as_of)).otherwise(F.col("last_seen"))
    ).drop("_same")


def merge_fingerprints(current: DataFrame, updates: DataFrame, as_of: str) -> DataFrame:
    """Upsert; ``first_seen`` stays, and a missing ``canonical_id`` keeps the old one.

    ``updates`` holds (fingerprint, content_hash, canonical_id), one row per fingerprint.
    """
    now = dates.as_ntz(as_of)
    c, u = current.alias("c"), updates.alias("u")
    touched = F.col("u.fingerprint").isNotNull()
    return c.join(u, "fingerprint", "full_outer").select(
        "fingerprint",
        F.coalesce("u.canonical_id", "c.canonical_id").alias("canonical_id"),
        F.coalesce("u.content_hash", "c.content_hash").alias("content_hash"),
        F.coalesce("c.first_seen", now).alias("first_seen"),
        F.when(touched, now).otherwise(F.col("c.last_seen")).alias("last_seen"),
    )


def source_priority(source: Column, url: Column | None = None) -> Column:
    """Position in the source ranking; an unknown source ranks by the longest listed end of its url's host, else last."""
    order = F.array(*[F.lit(s) for s in K.SOURCE_ORDER])
    at = F.array_position(order, source)
    last = F.lit(len(K.SOURCE_ORDER))
    if url is not None:
        ranks = F.lit([K.SOURCE_ORDER.index(s) for s in K.HOST_SOURCES.values()])
        last = F.coalesce(let(F.split(urls.host_of(url), r"\."), lambda labels: F.get(ranks, F.try_element_at(F.filter(F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda k: F.array_position(F.lit(list(K.HOST_SOURCES)), F.array_join(F.slice(labels, k, F.size(labels)), "."))),
            lambda p: p > 0), F.lit(1)).cast("int") - 1)), last)
    return F.when(at > 0, at - 1).otherwise(last).cast("int")


def gather_reasons(listings: DataFrame, fingerprints: DataFrame, scores: DataFrame, as_of: str,
                   min_days: int = 0, max_days: int = 10) -> DataFrame:
    """Every listing with ``reject_reason`` (null = qualified), cheapest test first.

    Scores are joined only to rows that passed the window, keyword and change tests.
    """
    excluded, groups = filters.keyword_columns(
        F.col("title"), F.col("description"), K.KEYWORDS, K.KEYWORD_EXCLUDES)
    timely = F.coalesce(
        filters.in_lead(F.col("start_dt"), as_of, min_days, max_days), F.lit(False))
    wanted = ~excluded & (F.size(groups) > 0)
    early = with_keys(listings.filter(~timely | ~wanted)).withColumn(
        "reject_reason", F.when(~timely, "window").otherwise("keyword"))
    near = filters.lead_window(listings, as_of, min_days, max_days).filter(wanted)
    rest = classify_changes(with_keys(near), fingerprints)
    scored = filters.relevance_columns(rest.join(scores.withColumn("_scored", F.lit(True)), "fingerprint", "left"))
    judged = scored.withColumn(
        "reject_reason", F.when(F.col("change") == "unchanged", "seen")
        .when(F.col("_scored").isNull(), "unscored")
        .when(~F.col("qualified"), "score")).drop("_scored")
    return judged.unionByName(early, allowMissingColumns=True)


def gather_report(reasons: DataFrame) -> DataFrame:
    """Counts of raw, qualified and skipped listings by reason, in one pass."""
    r = F.col("reject_reason")
    return reasons.agg(
        F.count("*").alias("raw"),
        F.count_if(r.isNull()).alias("qualified"),
        *[F.count_if(r == x).alias(f"skipped_{x}") for x in ("window", "keyword", "seen", "unscored", "score")],
    )


def to_candidates(qualified: DataFrame) -> DataFrame:
    """Hand-off rows of stage 1, keyed by fingerprint."""
    return qualified.withColumn("candidate_id", F.col("fingerprint")).withColumn(
        "priority", source_priority(F.col("source")))


def replace_candidates(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Insert or replace by id; the update wins."""
    both = current.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    return latest_per_key(both, "candidate_id", F.desc("_new")).drop("_new")


def clear_candidates(current: DataFrame, consumed: DataFrame) -> DataFrame:
    return current.join(consumed.select("candidate_id"), "candidate_id", "left_anti")


def ordered_candidates(candidates: DataFrame) -> DataFrame:
    """Source priority first, then best score; ids make the order total."""
    return candidates.orderBy(
        F.asc("priority"), F.desc_nulls_last("relevance_avg"), F.asc("candidate_id"))
