"""Venue pictures from landed venue pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import text, urls
from listflow.sources.feeds import attribute


def _any(c: Column, terms: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(t)) for t in terms])


def _ends(c: Column, terms: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.endswith(c, F.lit(t)) for t in terms])


def _plausible(url: Column) -> Column:
    low = F.lower(url)
    return (F.rlike(low, F.lit(r"^https?://")) & ~_ends(F.split_part(low, F.lit("?"), F.lit(1)), [".svg", ".gif", ".ico"])
            & ~_any(low, K.IMAGE_CHROME_WORDS))


def photo_candidates(pages: DataFrame) -> DataFrame:
    """(page_id, tier, pos, area, photo_url): usable pictures a page declares or shows.

    Tier 0 are social-card images in declared order, tier 1 in-page images from the same site
    or an asset host, photographic and not small. Tags are cut out and exploded in the JVM.
    """
    tags = lambda name: F.regexp_extract_all("html", F.lit(rf"(?is)<{name}\s[^>]*>"), 0)
    keyed = F.transform(tags("meta"), lambda m: F.struct(
        F.lower(F.trim(F.coalesce(attribute(m, "property"), attribute(m, "name")))).alias("key"),
        F.trim(attribute(m, "content")).alias("content")))
    declared = lambda k: F.try_element_at(F.filter(
        keyed, lambda m: (m["key"] == k) & (m["content"] != "")), F.lit(1))["content"]
    linked = F.try_element_at(F.filter(tags("link"), lambda x: F.array_contains(
        F.split(F.lower(F.coalesce(attribute(x, "rel"), F.lit(""))), r"\s+"), "image_src")), F.lit(1))
    none = F.lit(None).cast("string")
    social = F.array(*[declared(k) for k in K.META_IMAGE_KEYS], attribute(linked, "href"))
    top = F.transform(social, lambda u, i: F.struct(
        F.lit(0).alias("tier"), i.alias("pos"), u.alias("src"), none.alias("tag")))
    body = F.transform(tags("img"), lambda g, i: F.struct(
        F.lit(1).alias("tier"), i.alias("pos"),
        F.coalesce(attribute(g, "src"), attribute(g, "data-src")).alias("src"), g.alias("tag")))
    rows = pages.select("page_id", "url", F.explode(F.filter(
        F.concat(top, body), lambda c: ~text.is_blank(c["src"]))).alias("c")).select("page_id", "url", "c.*")
    side = lambda n: F.nullif(F.regexp_extract(
        F.coalesce(attribute(F.col("tag"), n), F.lit("")), r"^\s*(\d+)", 1), F.lit("")).try_cast("int")
    found = rows.withColumns({
        "photo_url": urls.absolute_url(F.col("url"), text.unescape(F.trim("src"))),
        "_w": side("width"), "_h": side("height"),
        "_marks": F.lower(F.concat_ws(" ", *[attribute(F.col("tag"), a) for a in ("class", "id", "alt", "title")])),
    }).filter(F.col("photo_url").isNotNull() & _plausible(F.col("photo_url")))
    host, page_host = urls.host_of(F.col("photo_url")), urls.host_of(F.col("url"))
    near = (urls.registrable_domain(host) == urls.registrable_domain(page_host)) | _any(host, K.CDN_HOST_HINTS)
    path = F.lower(urls.url_path(F.col("photo_url")))
    large = (F.coalesce("_w", F.lit(K.MIN_IMAGE_SIDE)) >= K.MIN_IMAGE_SIDE) & (
        F.coalesce("_h", F.lit(K.MIN_IMAGE_SIDE)) >= K.MIN_IMAGE_SIDE)
    inline = near & ~_ends(path, K.NON_PHOTO_EXTENSIONS) & ~_any(F.col("_marks"), K.IMAGE_CHROME_WORDS) & large
    return found.filter((F.col("tier") == 0) | inline).select(
        "page_id", "tier", "pos",
        (F.coalesce("_w", F.lit(0)).cast("bigint") * F.coalesce("_h", F.lit(0))).alias("area"), "photo_url")


def best_image_per_venue(candidates: DataFrame, key: str = "page_id") -> DataFrame:
    """The first declared picture, else the largest shown one."""
    w = Window.partitionBy(key).orderBy(
        "tier", F.when(F.col("tier") == 0, F.lit(0)).otherwise(-F.col("area")), "pos")
    return candidates.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(key, "tier", "photo_url")
