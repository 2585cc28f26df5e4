"""Deterministic keys and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hash16(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def content_hash(start: Column, venue: Column, price: Column) -> Column:
    """Hash of the three fields that make a listing materially different."""
    return _hash16(F.concat(_text(start), F.lit("|"), _text(venue), F.lit("|"), _text(price)))


def fingerprint(source: Column, source_id: Column) -> Column:
    return F.concat(source, F.lit(":"), source_id)


def canonical_id(title: Column, start: Column, venue: Column) -> Column:
    """Event id from title, start to the minute, and venue."""
    seed = F.concat(
        F.trim(F.lower(_text(title))), F.lit("|"), F.substring(_text(start), 1, 16), F.lit("|"),
        F.trim(F.lower(_text(venue))))
    return F.concat(F.lit("evt_"), _hash16(seed))


def article_id(event_id: Column, event_hash: Column) -> Column:
    """Article id that is the same whenever the same event state is seen again."""
    return F.concat(
        F.lit("art_"), F.substring(F.sha2(F.concat(event_id, F.lit("|"), event_hash), 256), 1, 12))
