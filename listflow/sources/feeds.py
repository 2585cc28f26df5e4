"""Landed RSS and Atom bodies to listings.

Items and their child elements are cut out with expressions, so a malformed item spoils only
itself and every element, known or not, stays available for provenance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import dates, structs, text, urls
from listflow.functions.binding import let
from listflow.operators import filters
from listflow.sources.listings import conform

_ITEM = r"(?is)<(?:item|entry)(?:\s[^>]*)?>(.*?)</(?:item|entry)\s*>"
_CHILD = r"(?s)<([A-Za-z_][\w:.\-]*)((?:\s[^<>]*?)?)(?:/>|>(.*?)</\1\s*>)"
_GROUP = r"(?i)</?media:group(?:\s[^<>]*)?>"
#: Stands for ``<`` inside a CDATA section while elements are cut; no text holds this noncharacter.
_SHIELD = "\ufdd0"
#: Stand around a child element and between its parts while items are cut.
_EDGE, _PART = "\ufdd1", "\ufdd2"
_IMG_SRC = r"""(?i)<img[^>]+src=["']([^"']+)["']"""


def attribute(tag: Column, name: str) -> Column:
    """Value of one attribute of a tag's text, or null."""
    quoted = F.regexp_extract(tag, rf"""(?is)(?<![\w:-]){name}\s*=\s*(["'])(.*?)\1""", 2)
    bare = F.regexp_extract(tag, rf"""(?is)(?<![\w:-]){name}\s*=\s*([^\s"'>]+)""", 1)
    return F.coalesce(F.nullif(quoted, F.lit("")), F.nullif(bare, F.lit("")))


def _shielded(body: Column) -> Column:
    """A body whose CDATA sections hold no ``<``, so that markup in them ends no element."""
    sections = F.split(body, r"<!\[CDATA\[")
    closed = lambda s: F.instr(s, "]]>")
    shield = lambda s: F.when(closed(s) > 0, F.concat(
        F.replace(F.substring(s, F.lit(1), closed(s) - 1), F.lit("<"), F.lit(_SHIELD)),
        F.substring(s, closed(s), F.length(s)))).otherwise(s)
    return F.when(F.contains(body, F.lit("<![CDATA[")), F.array_join(
        F.transform(sections, lambda s, i: F.when(i == 0, s).otherwise(shield(s))), "<![CDATA[")).otherwise(body)


def _children(item: Column) -> Column:
    """Child elements in order as ARRAY<STRUCT<key, attrs, text>>; prefix:name reads prefix_name.

    Members of a media group count as the item's own children.
    """
    def child(tag: Column, attrs: Column, inner: Column) -> Column:
        return F.struct(F.replace(F.lower(tag), F.lit(":"), F.lit("_")).alias("key"),
                        attrs.alias("attrs"), F.replace(inner, F.lit(_SHIELD), F.lit("<")).alias("text"))

    def marked(x: Column) -> Column:
        cut = F.split(F.regexp_replace(x, _CHILD, f"{_EDGE}$1{_PART}$2{_PART}$3{_EDGE}"), _EDGE)
        return F.transform(F.filter(cut, lambda _, i: i % 2 == 1), lambda c: let(
            F.split(c, _PART), lambda p: child(p[0], p[1], p[2])))

    def matched(x: Column) -> Column:
        part = lambda i: F.regexp_extract_all(x, F.lit(_CHILD), i)
        return F.transform(F.arrays_zip(part(1).alias("tag"), part(2).alias("attrs"), part(3).alias("text")),
                           lambda c: child(c["tag"], c["attrs"], c["text"]))

    # one match for all parts, unless the item holds the marks itself
    return let(F.regexp_replace(item, _GROUP, ""), lambda x: F.when(
        F.contains(x, F.lit(_EDGE)) | F.contains(x, F.lit(_PART)), matched(x)).otherwise(marked(x)))


def _plain(c: Column) -> Column:
    """Element text: a CDATA section as it stands, else with entities resolved."""
    inner = F.regexp_extract(c, r"(?s)<!\[CDATA\[(.*?)\]\]>", 1)
    return F.when(F.contains(c, F.lit("<![CDATA[")), inner).otherwise(text.unescape(c))


def _parsed(item: Column) -> Column:
    """An item's children, and among them the ones with text and the ones with attributes."""
    return let(_children(item), lambda cs: F.struct(
        cs.alias("children"), F.filter(cs, lambda c: ~text.is_blank(c["text"])).alias("filled"),
        F.filter(cs, lambda c: c["attrs"] != "").alias("tagged")))


def _first_text(entry: Column, key: str) -> Column:
    return F.try_element_at(F.filter(entry["filled"], lambda c: c["key"] == key), F.lit(1))["text"]


def _usable(entry: Column) -> Column:
    """Whether an item has a title and some link."""
    titled = ~text.is_blank(F.regexp_replace(
        _first_text(entry, "title"), r"(?i)&(?:nbsp|#160|#xa0);", " "))
    linked = F.exists(entry["children"], lambda c: (c["key"] == "link") & (
        ~text.is_blank(c["text"]) | attribute(c["attrs"], "href").isNotNull()))
    return F.coalesce(titled & linked, F.lit(False))


def _child(*keys: str) -> Column:
    """Raw text of the first non-blank child of the first key that has one."""
    named = F.filter("e.filled", lambda c: c["key"].isin(*keys))
    if len(keys) == 1:
        return F.get(named, F.lit(0))["text"]
    order = F.array(*[F.lit(k) for k in keys])
    return let(named, lambda n: F.when(F.size(n) < 2, F.get(n, F.lit(0))["text"]).otherwise(F.array_min(F.transform(
        n, lambda c, i: F.struct(F.array_position(order, c["key"]).alias("rank"), i.alias("at"), c["text"].alias("text"))))["text"]))


def _child_attr(keys: list[str], name: str, where=None) -> Column:
    """Attribute of the first child among ``keys`` (in key order) that has it."""
    def first(key):
        ok = lambda c: (c["key"] == key) & attribute(c["attrs"], name).isNotNull() & (
            where(c) if where else F.lit(True))
        return attribute(F.try_element_at(F.filter("e.tagged", ok), F.lit(1))["attrs"], name)

    return F.coalesce(*[first(k) for k in keys])


def _alias(group: str) -> Column:
    return _child(*K.FEED_ALIASES[group])


def source_label(configured: Column, feed_url: Column, title: Column) -> Column:
    """Configured label, else the host's first label, else the feed title."""
    host = F.regexp_replace(urls.host_of(feed_url), r"^www\.", "")
    return F.coalesce(text.clean_text(configured), F.nullif(F.split_part(host, F.lit("."), F.lit(1)), F.lit("")),
                      text.clean_text(title), F.lit("rss"))


def feed_entries(feeds: DataFrame, as_of: str, use_published_as_start: bool = False) -> DataFrame:
    """One listing per entry that has a link and a title.

    ``feeds`` (feed_url, source, body). Each detail comes from the first non-empty of an
    ordered alias list; everything unread is kept in ``raw``.
    """
    head = F.regexp_extract("body", r"(?is)^(.*?)<(?:item|entry)[\s>]", 1)
    items = feeds.select(
        "feed_url", "source",
        F.regexp_extract(head, r"(?is)<title[^>]*>(.*?)</title>", 1).alias("feed_title"),
        F.regexp_extract(head, r"(?is)<link[^>]*>(.*?)</link>", 1).alias("feed_link"),
        F.posexplode(F.regexp_extract_all(_shielded(F.col("body")), F.lit(_ITEM), 1)).alias("entry_pos", "item"))
    # Testing inside the explode keeps the optimizer from repeating the parse in a pushed filter.
    read = items.withColumn("e", F.explode(F.filter(F.array(_parsed(F.col("item"))), _usable))).drop("item")
    now = dates.as_ntz(as_of)
    alternate = lambda c: F.coalesce(attribute(c["attrs"], "rel"), F.lit("alternate")) == "alternate"
    raw_parts = read.withColumns({
        "_title": _child("title"),
        "_link": F.coalesce(_child("link"), _child_attr(["link"], "href", alternate)),
        "_id": _child("id", "guid"),
        "_content": _child("content_encoded", "content"),
        "_summary": _child("summary", "subtitle", "description"),
        "_media": F.coalesce(
            _child_attr(["media_thumbnail", "media_content"], "url"),
            _child_attr(["enclosure"], "url", lambda c: F.startswith(
                F.coalesce(attribute(c["attrs"], "type"), F.lit("")), F.lit("image/"))),
            _child_attr(["link"], "href", lambda c: (attribute(c["attrs"], "rel") == "enclosure") & F.startswith(
                F.coalesce(attribute(c["attrs"], "type"), F.lit("")), F.lit("image/")))),
        **{f"_{g}": _alias(g) for g in K.FEED_ALIASES},
        "_published": _child("published", "pubdate", "updated", "dc_date") if use_published_as_start else F.lit(None).cast("string"),
    })
    plain = raw_parts.withColumns({
        c: _plain(F.col(c)) for c in ("_title", "_link", "_id", "_content", "_summary", "_media",
                                      "_published", *[f"_{g}" for g in K.FEED_ALIASES])})
    base = F.col("feed_url")
    in_body = F.coalesce(*[F.nullif(F.regexp_extract(c, _IMG_SRC, 1), F.lit(""))
                           for c in ("_summary", "_content")])
    consumed = F.array(*[F.lit(k) for k in K.FEED_BODY_KEYS + ["enclosure", "content_encoded"]
                         + [k for ks in K.FEED_ALIASES.values() for k in ks]])
    listing = plain.select(
        source_label(F.col("source"), base, F.col("feed_title")).alias("source"),
        F.col("_id").alias("source_id"),
        urls.absolute_url(base, text.clean_text(F.col("_link"))).alias("url"),
        F.col("_title").alias("title"),
        F.coalesce(text.strip_html(F.col("_content")), text.strip_html(F.col("_summary"))).alias("description"),
        F.coalesce(dates.parse_event_dt(F.col("_start"), now),
                   dates.parse_event_dt(F.col("_published"), now)).alias("start_dt"),
        dates.parse_event_dt(F.col("_end"), now).alias("end_dt"),
        F.col("_venue").alias("venue_name"), F.col("_address").alias("venue_address"),
        F.col("_price").alias("price"),
        urls.absolute_url(base, text.clean_text(F.col("_register"))).alias("register_url"),
        urls.absolute_url(base, F.coalesce("_media", in_body)).alias("image_url"),
        structs.jsonable(F.struct(
            F.lit("rss").alias("_parser"), base.alias("_feed_url"),
            F.struct(text.clean_text(F.col("feed_title")).alias("title"),
                     text.clean_text(F.col("feed_link")).alias("link")).alias("feed"),
            F.col("e.children").alias("entry"),
            F.filter("e.children", lambda c: ~F.array_contains(consumed, c["key"])).alias("_unmapped"),
        )).alias("raw"),
        "feed_url", "entry_pos")
    return filters.normalize_listing(conform(listing))
