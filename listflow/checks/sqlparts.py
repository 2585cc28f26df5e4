"""SQL fragments the DuckDB oracles share."""

from __future__ import annotations

from listflow import constants as K
from listflow.checks.fixtures import AS_OF

NOW = f"timestamp '{AS_OF}'"
_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'))"


def clean(c: str) -> str:
    return f"nullif({collapse(c)}, '')"


def name_key(c: str) -> str:
    return f"nullif(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), '')"


def venue_key(c: str) -> str:
    bare = rf"regexp_replace(lower({c}), '\s*\([^()]*\)\s*$', '')"
    return rf"nullif(regexp_replace(trim(regexp_replace({bare}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')), '^the ', ''), '')"


def street_key(c: str) -> str:
    found = rf"regexp_extract({c}, '^\s*(\d+\s+[^,]+)', 1)"
    return rf"nullif(trim(regexp_replace(lower({found}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), '')"


def any_of(hay: str, terms: list[str]) -> str:
    return "(" + " or ".join(f"contains({hay}, {q(t)})" for t in terms) + ")"


HAY = "lower(coalesce(title, '') || ' ' || coalesce(description, ''))"
EXCLUDED = any_of(HAY, K.KEYWORD_EXCLUDES)
GROUPS = {g: any_of(HAY, t) for g, t in K.KEYWORDS.items()}
INCLUDED = "(" + " or ".join(GROUPS.values()) + ")"
CONTENT_HASH = ("substr(sha256(coalesce(cast(start_dt as varchar), '') || '|' || coalesce(venue_name, '')"
                " || '|' || coalesce(price, '')), 1, 16)")
PRIORITY = ("case source " + " ".join(f"when {q(s)} then {i}" for i, s in enumerate(K.SOURCE_ORDER))
            + f" else {len(K.SOURCE_ORDER)} end")
HAVERSINE = (f"2 * {K.EARTH_RADIUS_M} * asin(sqrt(least(1.0, pow(sin((radians({{b}}lat) - radians({{a}}lat)) / 2), 2)"
             " + cos(radians({a}lat)) * cos(radians({b}lat)) * pow(sin(radians({b}lon - {a}lon) / 2), 2))))")


def values(rows: list[tuple], names: list[str], alias: str) -> str:
    """A literal table as a FROM item."""
    def cell(v):
        return "null" if v is None else q(v) if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows)
    return f"(values {body}) {alias}({', '.join(names)})"
