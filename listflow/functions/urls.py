"""URL helpers, Column -> Column."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _join(base: str | None, href: str | None) -> str | None:
    if base is None or not href or href.startswith(("#", "javascript:", "mailto:", "tel:")):
        return None
    try:
        return urljoin(base, href) or None
    except ValueError:
        return None


@F.pandas_udf(StringType())
def _resolve(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([_join(b, h) for b, h in zip(base, href)], dtype=object)


#: Not moved or repeated by the optimizer: each row crosses to Python at most once.
_resolve = _resolve.asNondeterministic()


def joined(base: Column, href: Column) -> Column:
    """Struct (href, url) of a trimmed link and, if it needs no Python, what it resolves to."""
    h = F.regexp_replace(F.coalesce(href, F.lit("")), r"(?U)^\s+|\s+$", "")
    prefix = (
        F.when(F.rlike(h, F.lit(r"^https?://[^/]")), F.lit(""))
        .when(F.rlike(h, F.lit(r"^//[^/]")), F.nullif(F.regexp_extract(
            base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), F.lit("")))
        .when(F.rlike(h, F.lit(r"^/(?:[^/]|$)")), F.nullif(F.regexp_extract(
            base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), F.lit(""))))
    plain = ~F.rlike(h, F.lit(r"/\.{1,2}(?:/|$|[?#])|[?#]$"))
    return F.struct(h.alias("href"), F.when(plain, F.concat(prefix, h)).alias("url"))


def resolved(base: Column, link: Column) -> Column:
    """The URL of what ``joined`` gave; a caller that holds it as a column has it computed once."""
    left = link["url"].isNull()
    return F.coalesce(link["url"], _resolve(F.when(left, base), F.when(left, link["href"])))


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve a link against its page; fragments and non-web schemes become null.

    Absolute, scheme-relative and root-relative links are resolved in the JVM. The rest
    (dot segments, document-relative paths) go to Python, nulls standing in for other rows.
    """
    return resolved(base, joined(base, href))


def url_key(c: Column) -> Column:
    """URL for matching: lower host, no scheme, query, fragment or trailing slash."""
    bare = F.regexp_replace(F.trim(c), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"(?s)[?#].*$", ""), r"/$", "")
    path = F.regexp_replace(bare, r"^[^/]*", "")
    return F.nullif(F.concat(F.lower(F.regexp_extract(bare, r"^[^/]*", 0)), path), F.lit(""))


def host_of(c: Column) -> Column:
    """Lowercase host, without user info or port."""
    netloc = F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(netloc, r"^.*@", ""), r":\d*$", ""))


def url_path(c: Column) -> Column:
    """Path part of an absolute URL."""
    return F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)


def registrable_domain(host: Column) -> Column:
    """Last two labels of a host."""
    labels = F.filter(F.split(F.lower(F.coalesce(host, F.lit(""))), r"\."), lambda p: p != "")
    return F.array_join(
        F.when(F.size(labels) >= 2, F.slice(labels, -2, 2)).otherwise(labels), ".")
