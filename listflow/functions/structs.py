"""Maps, nested drafts and JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NO_ATTEMPTS = "map<string,int>"


def attempt_bump(attempts: Column, stage: Column) -> Column:
    """Counter map with one key increased by one."""
    current = F.coalesce(attempts, F.create_map().cast(_NO_ATTEMPTS))
    one = F.create_map(stage, F.lit(1))
    return F.map_zip_with(
        current, one,
        lambda k, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def attempt_reset(attempts: Column, stage: Column) -> Column:
    """Counter map without one key."""
    current = F.coalesce(attempts, F.create_map().cast(_NO_ATTEMPTS))
    return F.map_filter(current, lambda k, v: k != stage)


def overlay(draft: Column, revised: Column, fields: list[str]) -> Column:
    """Draft struct with every non-empty revised field laid over it."""
    for f in fields:
        new = revised[f]
        draft = draft.withField(
            f, F.when(new.isNotNull() & (new.cast("string") != ""), new).otherwise(draft[f]))
    return draft


def extract_json_payload(text: Column) -> Column:
    """JSON in a response text as VARIANT: bare, fenced, widest brace span, else null."""
    trimmed = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    fenced = F.regexp_extract(
        trimmed, r"(?s)```(?:json)?\s*(\{.*?\}|\[.*?\])\s*```", 1)
    return F.coalesce(
        F.try_parse_json(F.nullif(trimmed, F.lit(""))),
        F.try_parse_json(F.nullif(fenced, F.lit(""))),
        F.try_parse_json(F.nullif(F.regexp_extract(trimmed, r"(?s)\{.*\}", 0), F.lit(""))),
        F.try_parse_json(F.nullif(F.regexp_extract(trimmed, r"(?s)\[.*\]", 0), F.lit(""))),
    )


def jsonable(c: Column) -> Column:
    """A nested value as JSON text for provenance."""
    return F.to_json(c, {"ignoreNullFields": "false"})
