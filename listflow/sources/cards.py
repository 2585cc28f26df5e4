"""Listing cards on pages without structured events, by per-site selector lists."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import dates, structs, urls
from listflow.operators import filters
from listflow.session import dimension
from listflow.sources.listings import conform

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_STEP = re.compile(r"^([a-zA-Z][\w-]*)?((?:\.[\w-]+|#[\w-]+|\[[^\]]+\])*)$")
_COLUMNS = ("page_id long, page_url string, source string, card_pos int, card_id string, links array<string>, link_title string, title string, "
            "date_text string, description string, venue string, address string, price string, images array<string>")


class _Node:
    __slots__ = ("tag", "attrs", "parent", "parts", "classes")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.parts = tag, attrs, parent, []
        self.classes = attrs["class"].split() if "class" in attrs else ()

    def walk(self):
        """Descendants in document order."""
        found, ahead = [], [self]
        while ahead:
            node = ahead.pop()
            found.append(node)
            ahead += [p for p in reversed(node.parts) if p.__class__ is _Node]
        return found[1:]

    def text(self):
        said, ahead = [], [self]
        while ahead:
            part = ahead.pop()
            if part.__class__ is _Node:
                ahead += reversed(part.parts)
            else:
                said.append(part)
        return " ".join(" ".join(said).split())


class _Page(HTMLParser):
    def __init__(self, markup):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)
        self.feed(markup)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.parts.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.parts.append(_Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.parts.append(data)


@lru_cache(maxsize=10_000)
def _steps(selector: str) -> tuple[tuple | None, ...]:
    """A selector's simple steps, last first, as (tag, classes, id tests, attribute tests); one that is malformed is None."""
    read = []
    for step in reversed(selector.split()):
        found = _STEP.match(step)
        tests = re.findall(r"\.[\w-]+|#[\w-]+|\[[^\]]+\]", found[2]) if found else []
        named = [test[1:-1].partition("=") for test in tests if test[0] == "["]
        read.append(found and (
            (found[1] or "").lower(), tuple(t[1:] for t in tests if t[0] == "."), tuple(t[1:] for t in tests if t[0] == "#"),
            tuple((name, value.strip("\"'") if eq else None) for name, eq, value in named)))
    return tuple(read)


def _fits(node: _Node, step: tuple | None) -> bool:
    if step is None:
        return False
    tag, classes, ids, named = step
    if tag and node.tag != tag:
        return False
    for c in classes:
        if c not in node.classes:
            return False
    for i in ids:
        if node.attrs.get("id") != i:
            return False
    for name, value in named:
        if name not in node.attrs or value is not None and node.attrs[name] != value:
            return False
    return True


def _select(nodes: list[_Node], selector: str) -> Iterator[_Node]:
    """Those of ``nodes`` that fit a selector of blank-separated simple steps."""
    last, *outer = _steps(selector)
    for node in nodes:
        if not _fits(node, last):
            continue
        at, above = 0, node.parent
        while at < len(outer) and above is not None:
            if _fits(above, outer[at]):
                at += 1
            above = above.parent
        if at == len(outer):
            yield node


def _first(nodes: list[_Node], selectors: list[str]) -> _Node | None:
    for s in selectors:
        for n in _select(nodes, s):
            return n
    return None


def _cards(markup: str, spec: dict[str, list[str]]) -> Iterator[tuple]:
    """Raw fields of each card; the first selector that matches wins per field."""
    page = _Page(markup).root.walk()
    cards = next((c for c in (list(_select(page, s)) for s in spec["card"]) if c), [])
    for pos, card in enumerate(cards):
        nodes = card.walk()
        shown = {f: (n.text() or None) if (n := _first(nodes, spec[f])) else None
                 for f in ("title", "description", "venue", "address", "price")}
        stamp = _first(nodes, spec["date"])
        when = stamp and (next((v for a in ("datetime", "content", "data-date", "data-start")
                                if (v := " ".join(stamp.attrs.get(a, "").split()))), None) or stamp.text() or None)
        anchors = [n for s in spec["link"] for n in _select(nodes, s)]
        links = [n.attrs.get("href", "") for n in anchors]
        images = [n.attrs[a] for s in spec["image"] for n in _select(nodes, s)
                  for a in ("src", "data-src", "data-lazy-src", "content") if n.attrs.get(a)]
        yield (pos, card.attrs.get("data-event-id") or card.attrs.get("id") or None, links,
               anchors[0].attrs.get("title") if anchors else None, shown["title"], when, shown["description"],
               shown["venue"], shown["address"], shown["price"], images)


def _read_cards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names, specs = [c.split()[0] for c in _COLUMNS.split(", ")], {}
    for batch in batches:
        specs |= {said: json.loads(said) for said in batch["spec"].unique() if said not in specs}
        pages = zip(batch["page_id"], batch["url"], batch["source"], batch["html"], batch["spec"])
        rows = [(page, url, source, *card) for page, url, source, html, spec in pages
                for card in _cards(html, specs[spec])]
        yield pd.DataFrame(rows, columns=names)


def site_specs(spark: SparkSession, overrides: dict[str, dict] | None = None) -> DataFrame:
    """Selector lists per site as a dimension table (host, source, spec)."""
    merged = {**{k: dict(v) for k, v in K.SITE_SELECTORS.items()}}
    for name, change in (overrides or {}).items():
        merged[name] = {**merged.get(name, {}), **change}
    rows = []
    for name, site in merged.items():
        spec = {**K.CARD_DEFAULTS, **{k: v for k, v in site.items() if k in ("card", *K.CARD_DEFAULTS)}}
        spec = {k: [v] if isinstance(v, str) else list(v) for k, v in spec.items()}
        rows.append((site["host"], site.get("source", name), json.dumps(spec)))
    return dimension(spark, rows, ["host", "source", "spec"])


def listing_cards(pages: DataFrame, specs: DataFrame, as_of: str,
                  structured: DataFrame | None = None) -> DataFrame:
    """Listings from the cards of known sites; pages in ``structured`` (page_id) are left out.

    Only the markup reading is Python, one page at a time in Arrow batches; links, dates and
    the contract are expressions. A card needs a title and a link.
    """
    if structured is not None:
        pages = pages.join(structured.select("page_id").distinct(), "page_id", "left_anti")
    known = pages.withColumn("host", urls.host_of(F.col("url"))).join(specs, "host")
    rows = known.select("page_id", "url", specs["source"], "html", "spec").mapInPandas(_read_cards, _COLUMNS)
    junk = lambda h: F.rlike(F.trim(h), F.lit(r"^(?:$|#|javascript:|mailto:|tel:)"))
    usable = lambda c: F.try_element_at(F.filter(c, lambda h: ~junk(h)), F.lit(1))
    page, now = F.col("page_url"), dates.as_ntz(as_of)
    span = dates.split_dt_range(F.col("date_text"))
    timed = rows.withColumn("_span", span).withColumns({
        "_start": dates.parse_event_dt(F.col("_span.start_text"), now, roll_forward=True),
        "_end": dates.parse_event_dt(F.col("_span.end_text"), now, roll_forward=True)})
    url = urls.absolute_url(page, usable(F.col("links")))
    listing = timed.select(
        "source", F.coalesce("card_id", url).alias("source_id"), url.alias("url"),
        F.coalesce("title", "link_title").alias("title"), "description",
        F.col("_start").alias("start_dt"),
        dates.finish_range(F.col("_start"), F.col("_end"), F.col("_span.end_text")).alias("end_dt"),
        F.col("venue").alias("venue_name"), F.col("address").alias("venue_address"), "price",
        urls.absolute_url(page, usable(F.col("images"))).alias("image_url"),
        structs.jsonable(F.struct(
            F.lit("css").alias("_parser"), page.alias("_page_url"),
            F.struct("date_text", "venue", "address", "price").alias("fields"))).alias("raw"),
        "page_id", "card_pos")
    return filters.normalize_listing(conform(listing)).filter("title <> '' and url <> ''")
