"""Landed listings to qualified candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from listflow.operators import changes, filters
from listflow.session import cut_lineage


def new_or_changed(listings: DataFrame, fingerprints: DataFrame, as_of: str, min_days: int = 0,
                   max_days: int = 10) -> DataFrame:
    """Listings worth scoring: normalized, in the lead window, on topic, new or changed.

    A source's first copy of a listing decides, as in :func:`gather`, so copies go before the tests.
    """
    fresh = filters.dedupe_same_source(filters.normalize_listing(listings))
    near = filters.lead_window(fresh, as_of, min_days, max_days)
    return changes.change_filter(filters.keyword_filter(near), fingerprints)


def gather(listings: DataFrame, fingerprints: DataFrame, scores: DataFrame, as_of: str,
           min_days: int = 0, max_days: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidates in work order, next fingerprint state, report).

    The classified listings feed all three, so they are written once. A listing without a score is
    no candidate and stays out of the state, so the next run sees it as new again.
    """
    fresh = filters.dedupe_same_source(filters.normalize_listing(listings))
    reasons = cut_lineage(
        changes.gather_reasons(fresh, fingerprints, scores, as_of, min_days, max_days), "reasons")
    candidates = changes.ordered_candidates(
        changes.to_candidates(reasons.filter("reject_reason is null")))
    scored = reasons.filter("change in ('new', 'changed') and reject_reason is distinct from 'unscored'").selectExpr(
        "fingerprint", "content_hash", "cast(null as string) as canonical_id")
    state = changes.refresh_seen(
        changes.merge_fingerprints(fingerprints, scored, as_of),
        reasons.filter("change = 'unchanged'"), as_of)
    return candidates, state, changes.gather_report(reasons)
