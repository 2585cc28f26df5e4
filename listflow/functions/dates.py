"""Dates as Pacific wall-clock TIMESTAMP_NTZ, never the session time zone."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from dateutil import parser as _prose
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from listflow import constants as K
from listflow.functions.binding import let


_MONTH_WORD = "(?:" + "|".join(f"{m}|{m[:3]}" for m in K.MONTHS) + "|sept)"
_CLOCK = r"(0?[1-9]|1[0-2])(?::([0-5]\d))?\s*([ap])\.?m\.?"
_DAY_NUMBER = r"(0?[1-9]|[12]\d|3[01])"
_MONTH_NUMBER = r"(0?[1-9]|1[0-2])"
_WEEKDAY = "(?:(?:" + "|".join(f"{d}|{d[:3]}" for d in K.WEEKDAYS) + r")\.?,?\s+)?"
_AT = r"(?:,?\s+(?:at\s+|@\s*)?" + _CLOCK + ")?$"


def _int(c: Column) -> Column:
    return F.nullif(c, F.lit("")).try_cast("int")


def _make(y, mo, d, h, mi, s=None) -> Column:
    return F.try_make_timestamp_ntz(y, mo, d, h, mi, F.lit(0) if s is None else s)


def as_ntz(as_of: str | dt.datetime) -> Column:
    """The run's clock as a literal."""
    return F.lit(str(as_of)).cast("timestamp_ntz")


def midnight(c: Column) -> Column:
    return F.date_trunc("day", c).cast("timestamp_ntz")


def pacific_from_utc(c: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(K.PACIFIC), c)


def utc_from_pacific(c: Column) -> Column:
    return F.convert_timezone(F.lit(K.PACIFIC), F.lit("UTC"), c)


def wall_clock(c: Column, kind: str) -> Column:
    """Pacific wall-clock time of a landed column: ISO text, with or without a zone, or an instant.

    Text without a zone is wall-clock already; text in no ISO form is null.
    """
    if kind == "string":
        return let(F.trim(c), lambda x: F.coalesce(_iso(x), x.try_cast("timestamp_ntz")))
    if kind == "timestamp":
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        micros = F.unix_micros(c)
        return pacific_from_utc(start + F.make_dt_interval(
            secs=(micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")))
    return c.cast("timestamp_ntz")


def iso_pacific(c: Column) -> Column:
    """ISO text with the Pacific offset in force at that wall-clock time."""
    behind = F.timestamp_diff("HOUR", c, utc_from_pacific(c))
    return F.concat(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.format_string("-%02d:00", behind))


def _hour24(hour: Column, half: Column) -> Column:
    h = _int(hour)
    return F.when(h.between(1, 12), h % 12 + F.when(F.lower(half) == "p", 12).otherwise(0))


def _groups(t: Column, shape: str, n: int) -> Column:
    """The shape's groups as an array, from one match; only for text that fits the shape."""
    return F.split(F.regexp_replace(t, shape, "\u0001".join(f"${i}" for i in range(1, n + 1))), "\u0001")


def _read(t: Column, shape: str, n: int, build) -> Column:
    """``build`` over the groups when the text fits the shape, else null."""
    return F.when(F.rlike(t, F.lit(shape)), let(
        _groups(t, shape, n), lambda g: build(lambda i: F.get(g, F.lit(i - 1)))))


_ISO = (r"^(\d{4})-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])"
        r"(?:[T ]([01]\d|2[0-3]):([0-5]\d)(?::([0-5]\d)(?:[.,]\d+)?)?"
        r"\s*(Z|z|[+-]\d{2}:?\d{2})?)?$")


def _iso(t: Column) -> Column:
    def build(g):
        zero = lambda i: F.coalesce(_int(g(i)), F.lit(0))
        local = _make(_int(g(1)), _int(g(2)), _int(g(3)), zero(4), zero(5), zero(6))
        zone = F.regexp_replace(F.upper(g(7)), ":", "")
        minutes = F.when(zone == "Z", 0).otherwise(
            F.when(F.startswith(zone, F.lit("-")), -1).otherwise(1)
            * (F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, 4, 2).try_cast("int")))
        utc = local - F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))
        return F.when(zone == "", local).otherwise(pacific_from_utc(utc))

    return _read(t, _ISO, 7, build)


def _epoch(t: Column) -> Column:
    number = F.when(F.rlike(t, F.lit(_EPOCH)), t.try_cast("bigint"))
    seconds = F.when(F.length(t) >= 12, F.floor(number / 1000)).otherwise(number)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return pacific_from_utc(
        start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")))


def _month_number(word: Column) -> Column:
    prefixes = F.array(*[F.lit(m[:3]) for m in K.MONTHS])
    at = F.array_position(prefixes, F.substring(F.lower(word), 1, 3))
    return F.nullif(at, F.lit(0)).cast("int")


def _clocked(year, month, day, g, first) -> Column:
    hour = F.when(g(first) != "", _hour24(g(first), g(first + 2))).otherwise(F.lit(0))
    return _make(year, month, day, hour, F.coalesce(_int(g(first + 1)), F.lit(0)))


_EPOCH = r"^\d{9,13}$"
_MONTH_FIRST = (rf"(?i)^{_WEEKDAY}({_MONTH_WORD})\.?\s+{_DAY_NUMBER}(?:st|nd|rd|th)?"
                rf"(?:,?\s+(\d{{4}}))?{_AT}")
_DAY_FIRST = rf"(?i)^{_WEEKDAY}{_DAY_NUMBER}\s+({_MONTH_WORD})\.?,?\s+(\d{{4}}){_AT}"
_NUMERIC = rf"(?i)^{_MONTH_NUMBER}/{_DAY_NUMBER}(?:/(\d{{4}}|\d{{2}}))?{_AT}"
_NUMERIC24 = rf"^{_MONTH_NUMBER}/{_DAY_NUMBER}/(\d{{4}})\s+([01]?\d|2[0-3]):([0-5]\d)$"
_SLASHED = rf"^(\d{{4}})/{_MONTH_NUMBER}/{_DAY_NUMBER}$"
_TIME = rf"(?i)^{_CLOCK}$"
_TIME24 = r"^([01]?\d|2[0-3]):([0-5]\d)$"
_KNOWN = "|".join(f"(?:{x})" for x in (
    _ISO, _EPOCH, _MONTH_FIRST, _DAY_FIRST, _NUMERIC, _NUMERIC24, _SLASHED, _TIME, _TIME24))


def _prose_native(t: Column, anchor: Column) -> Column:
    """Month-name, numeric and time-only shapes that event calendars print."""
    this_year, zero = F.year(anchor), F.lit(0)

    def numeric(g):
        y = _int(g(3))
        full = F.when(F.length(g(3)) == 2, y + F.when(y >= 69, 1900).otherwise(2000)).otherwise(y)
        return _clocked(F.coalesce(full, this_year), _int(g(1)), _int(g(2)), g, 4)

    today = lambda hour, minute: _make(this_year, F.month(anchor), F.dayofmonth(anchor), hour, minute)
    return F.coalesce(
        _read(t, _MONTH_FIRST, 6, lambda g: _clocked(
            F.coalesce(_int(g(3)), this_year), _month_number(g(1)), _int(g(2)), g, 4)),
        _read(t, _DAY_FIRST, 6, lambda g: _clocked(_int(g(3)), _month_number(g(2)), _int(g(1)), g, 4)),
        _read(t, _NUMERIC, 6, numeric),
        _read(t, _NUMERIC24, 5, lambda g: _make(_int(g(3)), _int(g(1)), _int(g(2)), _int(g(4)), _int(g(5)))),
        _read(t, _SLASHED, 3, lambda g: _make(_int(g(1)), _int(g(2)), _int(g(3)), zero, zero)),
        _read(t, _TIME, 3, lambda g: today(_hour24(g(1), g(3)), F.coalesce(_int(g(2)), zero))),
        _read(t, _TIME24, 2, lambda g: today(_int(g(1)), _int(g(2)))),
    )


def _parse_rest(text: str | None, anchor: str | None) -> str | None:
    """Free-text remainder: strict reading first, then one that skips unknown words."""
    if not text or not anchor:
        return None
    default = dt.datetime.fromisoformat(anchor)
    for fuzzy in (False, True):
        try:
            found = _prose.parse(text, default=default, fuzzy=fuzzy)
        except (ValueError, OverflowError, TypeError):
            continue
        if found.tzinfo is not None:
            from zoneinfo import ZoneInfo
            found = found.astimezone(ZoneInfo(K.PACIFIC)).replace(tzinfo=None)
        return found.strftime("%Y-%m-%d %H:%M:%S") if found.year >= 1000 else None
    return None


@F.pandas_udf(StringType())
def _rest(text: pd.Series, anchor: pd.Series) -> pd.Series:
    return pd.Series([_parse_rest(t, a) for t, a in zip(text, anchor)], dtype=object)


#: Not moved or repeated by the optimizer: each row crosses to Python at most once.
_rest = _rest.asNondeterministic()


def event_text(c: Column) -> Column:
    """Published date text without its label and outer punctuation."""
    t = F.regexp_replace(F.regexp_replace(c, "\u00a0", " "), r"(?U)^\s+|\s+$", "")
    t = F.regexp_replace(
        t, r"(?i)^\s*(?:starts?|begins?|ends?|on|from|at|date|time)\s*[:\-]?\s+", "")
    t = F.nullif(F.regexp_replace(t, r"^[\s,;]+|[\s,;]+$", ""), F.lit(""))
    return F.regexp_replace(t, r"\s+", " ")


def read_event_text(t: Column, as_of: Column, free_text: bool = True) -> Column:
    """What ``event_text`` gave to Pacific wall-clock time, or null; a caller that holds it as a column has it computed once."""
    anchor = midnight(as_of)
    known = let(t, lambda x: F.coalesce(_iso(x), _epoch(x), _prose_native(x, anchor)))
    if free_text:
        left = F.when(~F.rlike(t, F.lit(_KNOWN)), t)
        known = F.coalesce(
            known, _rest(left, F.date_format(anchor, "yyyy-MM-dd HH:mm:ss")).try_cast("timestamp_ntz"))
    return known


def parse_event_dt(c: Column, as_of: Column, roll_forward: bool = False,
                   free_text: bool = True) -> Column:
    """Published date text to Pacific wall-clock time, or null.

    Known shapes are read in the JVM; only what remains goes to one Arrow UDF. With
    ``roll_forward`` a year-less date more than 45 days back moves to the next year.
    """
    known = read_event_text(event_text(c), as_of, free_text)
    if not roll_forward:
        return known

    def forward(x: Column) -> Column:
        day = F.when((F.month(x) == 2) & (F.dayofmonth(x) == 29), 28).otherwise(F.dayofmonth(x))
        next_year = _make(F.year(x) + 1, F.month(x), day, F.hour(x), F.minute(x),
                          F.second(x).cast("decimal(16,6)"))
        return F.when(x < midnight(as_of) - F.expr("interval 45 days"), next_year).otherwise(x)

    yearless = ~F.rlike(c, F.lit(r"\b\d{4}\b"))
    return let(F.struct(known.alias("at"), yearless.alias("yearless")),
               lambda x: F.when(x["yearless"], let(x["at"], forward)).otherwise(x["at"]))


_RANGE = r"(?i)\s+(?:-|to|until|thru|through|till)\s+|\s*[‐-―−]\s*"


def split_dt_range(c: Column) -> Column:
    """Struct (start_text, end_text) of a displayed range; ISO dates stay whole."""
    from listflow.functions.text import clean_text

    cleaned = clean_text(c)
    parts = F.filter(
        F.transform(F.split(cleaned, _RANGE), lambda p: F.trim(p)), lambda p: p != "")
    ranged = F.size(parts) >= 2
    return F.struct(
        F.when(ranged, parts[0]).otherwise(cleaned).alias("start_text"),
        F.when(ranged, parts[1]).alias("end_text"),
    )


def finish_range(start: Column, end: Column, end_text: Column) -> Column:
    """End of a displayed range: a bare end time takes the start's date, past midnight the next."""
    def finish(x: Column) -> Column:
        s, e = x["start"], x["end"]
        same_day = midnight(s) + (e - midnight(e))
        moved = F.when(same_day < s, same_day + F.expr("interval 1 day")).otherwise(same_day)
        return F.when((e < s) & x["bare"], moved).otherwise(e)

    bare = ~F.rlike(end_text, F.lit(r"\b\d{4}\b"))
    return let(F.struct(start.alias("start"), end.alias("end"), bare.alias("bare")), finish)


def details_when(c: Column) -> Column:
    """"Saturday, August 22, 9:00 AM"."""
    return F.date_format(c, "EEEE, MMMM d, h:mm a")
