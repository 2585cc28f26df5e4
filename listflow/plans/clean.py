"""Candidates to canonical events and their articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listflow.operators import matching, merging, work
from listflow.session import cut_lineage


def group_members(candidates: DataFrame) -> DataFrame:
    """Candidates with their ``group_id`` and ``member_id``."""
    groups = matching.resolve_entities(candidates).withColumnRenamed("id", "pos")
    return candidates.join(groups, "pos").withColumn("member_id", F.col("fingerprint"))


def clean(candidates: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(events, new articles, fingerprint updates that carry the canonical id).

    Every member keeps its own content hash; only the canonical id is new.
    """
    members = cut_lineage(group_members(candidates), "members")
    events = cut_lineage(merging.canonical_events(members), "events")
    updates = members.join(events.select("group_id", "event_id"), "group_id").select(
        "fingerprint", "content_hash", F.col("event_id").alias("canonical_id"))
    return events, work.new_articles(events), updates
