"""Text helpers, Column -> Column."""

from __future__ import annotations

import html
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from listflow import constants as K
from listflow.functions.binding import let

#: Unicode-aware whitespace, the class Python's str methods use.
SPACES = r"(?U)[\s\x1c-\x1f]+"


#: The same class; printable ASCII, most of all text, is ruled out by one comparison.
_SPACE = r"[\x00- \x7f-\x{10ffff}&&[\s\x1c-\x1f]]"
#: Runs of whitespace that are not one blank already, so that most text is only scanned.
_UNEVEN = rf"(?U){_SPACE}(?:(?<! ){_SPACE}*|{_SPACE}+)"
_SOLID = r"(?U)[^\s\x1c-\x1f]"


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _UNEVEN, " "))


def clean_text(c: Column) -> Column:
    """Collapse whitespace; blank becomes null."""
    return F.nullif(collapse(c), F.lit(""))


def is_blank(c: Column) -> Column:
    return c.isNull() | ~F.rlike(c, F.lit(_SOLID))


def first_value(*cols: Column) -> Column:
    """First value that is neither null nor blank, copied verbatim."""
    return F.coalesce(*[F.when(~is_blank(c), c) for c in cols])


@F.pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


#: Not moved or repeated by the optimizer: each row crosses to Python at most once.
_unescape = _unescape.asNondeterministic()


def unescape(c: Column) -> Column:
    """HTML entities to characters. Only values holding '&' travel to Python."""
    return F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)


def strip_tags(c: Column) -> Column:
    """Text with a blank for each tag, entities kept."""
    broken = F.regexp_replace(c, r"(?i)</\s*(?:p|div|li|tr|h[1-6])\s*>|<\s*br\s*/?\s*>", " ")
    return F.regexp_replace(broken, r"<[^>]+>", " ")


def strip_html(c: Column) -> Column:
    """Markup to plain text; block closers and line breaks separate words."""
    return clean_text(unescape(strip_tags(c)))


def name_key(c: Column) -> Column:
    """Lowercase ASCII letters and digits, single spaces; nothing left becomes null."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " ")), F.lit(""))


def venue_key(c: Column) -> Column:
    """Venue name for matching: no trailing parenthetical, punctuation, or leading 'the'."""
    bare = F.regexp_replace(F.lower(c), r"\s*\([^()]*\)\s*$", "")
    words = F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " "))
    return F.nullif(F.regexp_replace(words, r"^the ", ""), F.lit(""))


def street_key(c: Column) -> Column:
    """Street number and street name, or null when the address has no number."""
    found = F.regexp_extract(c, r"^\s*(\d+\s+[^,]+)", 1)
    return F.nullif(F.trim(F.regexp_replace(F.lower(found), r"[^\p{L}\p{N}]+", " ")), F.lit(""))


_DAY = "(?:" + "|".join(f"{d}|{d[:3]}" for d in K.WEEKDAYS) + ")"
_MONTH = "(?:" + "|".join(f"{m}|{m[:3]}" for m in K.MONTHS) + ")"
_LEADING_DATE = (
    rf"^(?:{_DAY} )?(?:(?:{_MONTH} \d{{1,2}}(?:st|nd|rd|th)?(?: \d{{4}})?"
    rf"|\d{{1,2}} \d{{1,2}} \d{{2,4}}|\d{{4}} \d{{1,2}} \d{{1,2}}) )?"
)


def title_words(c: Column) -> Column:
    """Folded title without its wrappers: date, sponsor, ticketing words, trailing year."""
    t = F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    t = F.regexp_replace(t, _LEADING_DATE, "")
    t = F.regexp_replace(t, r"(?<=.) ?presented by .*$", "")
    t = F.regexp_replace(t, r"\b(?:tickets|registration)\b", " ")
    t = F.regexp_replace(F.trim(t), r" (?:19|20)\d{2}$", "")
    return collapse(t)


def title_tokens(c: Column) -> Column:
    """Distinct distinctive words of a title."""
    skip = F.array(*[F.lit(w) for w in K.STOPWORDS + K.GENERIC_TITLE_WORDS + [""]])
    return F.array_except(F.split(title_words(c), " "), skip)


def words(c: Column) -> Column:
    """Whitespace-separated words."""
    return F.filter(F.split(c, SPACES), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.coalesce(F.size(F.filter(F.split(c, SPACES), lambda w: w != "")), F.lit(0))


def paragraphs(c: Column) -> Column:
    """Blocks of prose separated by blank lines."""
    blocks = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), "\r\n", "\n"), "\n\n")
    trimmed = F.transform(
        blocks, lambda b: F.regexp_replace(b, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    return F.filter(trimmed, lambda b: b != "")


def slugify(stem: Column, start: Column) -> Column:
    """Kebab-case stem cut to 60 characters, then the event date when there is one."""
    kebab = F.regexp_replace(F.lower(F.coalesce(stem, F.lit(""))), r"[^a-z0-9]+", "-")
    kebab = F.substring(F.regexp_replace(kebab, r"^-+|-+$", ""), 1, K.SLUG_MAX)
    dated = F.concat(kebab, F.lit("-"), F.date_format(start, "yyyy-MM-dd"))
    return F.when(start.isNull(), kebab).otherwise(dated)


def contains_any(c: Column, terms: list[str]) -> Column:
    """Whether ``c`` holds any term as a substring.

    A term that contains another listed term cannot change the answer, so it is left out.
    """
    needed = [t for t in terms if not any(o != t and o in t for o in terms)]
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(t)) for t in needed])


def word_pattern(term: str) -> str:
    """Regex for one term as whole words, blanks inside it matching any whitespace."""
    quoted = r"\s+".join(r"\Q" + w + r"\E" for w in term.split())
    return rf"(?i)(?<![\p{{L}}\p{{N}}]){quoted}(?![\p{{L}}\p{{N}}])"


def contains_any_word(c: Column, terms: list[str]) -> Column:
    """Whether ``c`` holds any term as whole words.

    A term's longest plain word is looked for first, so that only text which holds it meets the
    term's regex; a word with other than ASCII characters may fold in more than one way.
    """
    def hit(low: Column, term: str) -> Column:
        plain = [w for w in term.split() if w.isascii()]
        whole = F.rlike(c, F.lit(word_pattern(term)))
        return F.contains(low, F.lit(max(plain, key=len).lower())) & whole if plain else whole

    return let(F.lower(c), lambda low: reduce(lambda a, b: a | b, [hit(low, t) for t in terms]))
