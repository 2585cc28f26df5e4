"""schema.org events in landed pages, read as VARIANT."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import dates, price, structs, text, urls
from listflow.functions.binding import let
from listflow.operators import filters
from listflow.sources.listings import conform

_SCRIPT = r"""(?is)<script[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script>"""


def _get(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$['{key}']", "variant")


def _items(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _node(v: Column, *keys: str, kind: str = "variant") -> Column:
    """The keys of a node as one struct, read in one pass; null for any other value."""
    return F.try_variant_get(v, "$", f"struct<{', '.join(f'`{k}`: {kind}' for k in keys)}>")


def _holds(v: Column) -> Column:
    """Whether a value is a list or a node."""
    return _node(v).isNotNull() | F.try_variant_get(v, "$", "array<struct<>>").isNotNull()


def _children(v: Column, keys: list[str]) -> Column:
    """A list's items or what a node holds under the keys, without missing ones; null for any other value."""
    held = let(_node(v, *keys), lambda n: F.when(n.isNotNull(), F.array_compact(F.array(*[n[k] for k in keys]))))
    return F.coalesce(_items(v), held)


def _types_hold(types: Column, test) -> Column:
    """Whether the test holds for one of a node's lowercased type names, given its struct of @type and type."""
    def names(t):
        return F.coalesce(
            F.filter(F.try_variant_get(t, "$", "array<string>"), lambda x: x.isNotNull()),
            let(_string(t), lambda x: F.when(x.isNotNull() & _node(t).isNull(), F.array(x))))

    found = F.coalesce(names(types["@type"]), names(types["type"]))
    return F.coalesce(F.exists(F.transform(found, lambda x: F.lower(x)), test), F.lit(False))


def _is_event(v: Column) -> Column:
    return let(_node(v, "@type", "type"), lambda n: _types_hold(
        n, lambda x: F.contains(x, F.lit("event")) & ~x.isin(*K.JSONLD_NOT_EVENTS)))


def jsonld_nodes(pages: DataFrame) -> DataFrame:
    """One row per event node (VARIANT) with the page's other columns; a block that does not parse is skipped.

    The walk is a fold over levels: it keeps the event nodes found so far and the values of the
    current level, so pages are read once, nothing is shuffled and no level is kept twice.
    """
    kept = [c for c in pages.columns if c != "html"]
    blocks = pages.select(*kept, F.posexplode(
        F.regexp_extract_all("html", F.lit(_SCRIPT), 1)).alias("block", "code"))
    parsed = blocks.select(*kept, "block", F.try_parse_json("code").alias("payload"))
    none = F.array().cast("array<variant>")

    def level(state: Column, _: Column) -> Column:
        return F.when(F.size(state["front"]) > 0, F.struct(
            F.concat(state["found"], F.filter(state["front"], _is_event)).alias("found"),
            F.flatten(F.transform(state["front"], lambda v: F.coalesce(_children(v, K.JSONLD_CHILD_KEYS), none))).alias("front"))).otherwise(state)

    walked = F.aggregate(F.sequence(F.lit(0), F.lit(K.JSONLD_MAX_DEPTH)),
                         F.struct(none.alias("found"), F.array("payload").alias("front")), level, lambda state: state["found"])
    return parsed.select(*kept, "block", F.posexplode(walked).alias("node_pos", "node"))


def _string(v: Column) -> Column:
    """A scalar's characters; a list or node as JSON text."""
    return F.try_variant_get(v, "$", "string")


def _clean(s: Column) -> Column:
    return let(text.collapse(s), lambda c: F.when(c != "", c))


def _opens(s: Column) -> Column:
    """Whether a value's text starts like a list or node; scalars may too, but lists and nodes start like nothing else."""
    return F.left(s, F.lit(1)).isin("[", "{")


def coerce_text(v: Column) -> Column:
    """The clean text of one value: a scalar's own, that of a list's first usable item, or of a node's first
    usable name-like field, however deep.

    Lists and nodes go down a level per step of a fold. What lies behind the first usable text of a level
    is dropped, so ``open`` keeps only what a search in depth would meet before ``text``.
    """
    def cell(x: Column) -> Column:
        return let(_string(x), lambda s: let(_opens(s) & _holds(x), lambda held: F.struct(
            F.when(held, x).alias("v"), F.when(~held, _clean(s)).alias("text"))))

    def level(state: Column, _: Column) -> Column:
        def cut(cells: Column) -> Column:
            at = F.array_position(F.transform(cells, lambda c: c["text"].isNotNull()), True).cast("int")
            ahead = F.when(at > 0, F.slice(cells, F.lit(1), at - 1)).otherwise(cells)
            return F.struct(ahead["v"].alias("open"), F.coalesce(
                F.when(at > 0, F.get(cells, at - 1)["text"]), state["text"]).alias("text"))

        def down(open_: Column) -> Column:
            reached = F.flatten(F.transform(open_, lambda v: _children(v, K.JSONLD_TEXT_KEYS)))
            return let(F.filter(F.transform(reached, cell), lambda c: c["v"].isNotNull() | c["text"].isNotNull()), cut)

        return F.when(F.size(state["open"]) > 0, down(state["open"])).otherwise(state)

    def searched(s: Column) -> Column:
        # no value nests deeper than it has opening brackets
        levels = F.sequence(F.lit(1), F.length(F.regexp_replace(s, r"[^\[{]+", "")))
        start = F.struct(F.array(v).alias("open"), F.lit(None).cast("string").alias("text"))
        return F.aggregate(levels, start, level, lambda state: state["text"])

    return let(_string(v), lambda s: F.when(_opens(s) & _holds(v), searched(s)).otherwise(_clean(s)))


def _deep_texts(pairs: list[tuple[Column, Column]]) -> Column:
    """The texts of those of many (string, value) pairs that open a list or node; null if none does.

    Most values are scalars whose string is enough, so the values themselves are read only here.
    """
    opened = reduce(lambda a, b: a | b, [_opens(s) for s, _ in pairs])
    return F.when(opened, F.transform(F.array(*[F.when(_opens(s), v) for s, v in pairs]), lambda v: F.when(v.isNotNull(), coerce_text(v))))


def _texts(strings: list[Column], deep: Column) -> list[Column]:
    """The text of each string, from ``_deep_texts`` where it opens a list or node."""
    return [F.nullif(F.when(_opens(s), F.get(deep, F.lit(k))).otherwise(text.collapse(s)), F.lit("")) for k, s in enumerate(strings)]


def _filled(s: Column) -> Column:
    """A value's string unless it is missing, JSON null or blank text."""
    return F.nullif(s, F.lit(""))


def _first_of(v: Column, usable) -> Column:
    """A list's first usable item, or the value itself when it is no list."""
    return F.when(F.try_variant_get(v, "$", "array<struct<>>").isNull(), v).otherwise(
        F.try_element_at(F.filter(_items(v), usable), F.lit(1)))


_ADDRESS = ["streetAddress", "addressLocality", "addressRegion", "postalCode"]
_OFFER = ["url", "priceCurrency", "lowPrice", "highPrice"]
_OWN = ["name", "url", "@id", "identifier", "description", "disambiguatingDescription", "startDate", "endDate", "image", "photo"]


def _place(location: Column) -> Column:
    return _first_of(location, lambda x: _filled(_string(x)).isNotNull())


def _address(place: Column) -> Column:
    return _first_of(_get(place, "address"), lambda x: _node(x).isNotNull())


def _place_values(place: Column, address: Column) -> list[Column]:
    """What ``_place_said`` reads: name, url, the parts of an address that is a node, and an address or place that is none."""
    return [_get(place, "name"), _get(place, "url"), *[_get(address, k) for k in _ADDRESS],
            F.when(_node(address).isNull(), address), F.when(~_holds(place), place)]


def _place_said(place: Column, texts: list[Column]) -> Column:
    name, url, street, city, region, postal, whole, bare = texts
    virtual = let(_node(place, "@type", "type"), lambda n: _types_hold(n, lambda x: F.contains(x, F.lit("virtuallocation"))))
    tail = F.nullif(F.concat_ws(" ", region, postal), F.lit(""))
    full = F.coalesce(whole, F.nullif(F.concat_ws(", ", street, city, tail), F.lit("")))
    return F.when(place.isNotNull(), F.when(virtual, F.struct(
        F.coalesce(name, F.lit("Online")).alias("venue_name"), url.alias("venue_address"))).otherwise(
        F.struct(F.coalesce(name, bare).alias("venue_name"), full.alias("venue_address"))))


_SAID = "struct<url: string, priceCurrency: string, lowPrice: string, highPrice: string, price: string, priceSpecification: variant>"


def _free(node: Column) -> Column:
    return F.coalesce(F.lower(F.try_variant_get(node, "$.isAccessibleForFree", "string")) == "true", F.lit(False))


def _offers(node: Column) -> Column:
    """Strings of a node's offers that are nodes themselves, as ``_OFFER`` names them and last the amount to show
    where there is no range; none if the node says that it is free."""
    given = F.coalesce(F.try_variant_get(node, "$.offers", f"array<{_SAID}>"), F.array(F.try_variant_get(node, "$.offers", _SAID)))
    return F.when(~_free(node), F.transform(F.filter(given, lambda o: o.isNotNull()), lambda o: F.array(*[o[k] for k in _OFFER], F.coalesce(
        _filled(o["price"]), _filled(F.try_variant_get(o["priceSpecification"], "$.price", "string")), _filled(o["lowPrice"])))))


def _offer_texts(node: Column, offers: Column) -> Column:
    """The clean texts of ``_offers``; the values themselves are read where one opens a list or node."""
    def value(o: Column) -> Column:
        amounts = F.array(*[F.try_variant_get(o, f"$.{k}", "variant") for k in ("price", "priceSpecification.price", "lowPrice")])
        return F.array(*[_get(o, k) for k in _OFFER], F.get(F.filter(amounts, lambda v: _filled(_string(v)).isNotNull()), F.lit(0)))

    def deep() -> Column:
        given = F.coalesce(F.try_variant_get(node, "$.offers", "array<variant>"), F.array(_get(node, "offers")))
        return F.transform(F.filter(given, lambda o: _node(o).isNotNull()), lambda o: F.transform(value(o), coerce_text))

    return F.when(F.exists(F.flatten(offers), _opens), deep()).otherwise(
        F.transform(offers, lambda o: F.transform(o, _clean)))


def _price_said(offers: Column, url: Column) -> Column:
    """Struct (price, offer_url) from the texts of each offer; no offers at all mean that the event is free."""
    def amount(o: Column) -> Column:
        return let(F.transform(F.slice(o, 3, 3), lambda x: price.format_amount(x, o[1])), lambda x: F.when(
            x[0] != x[1], F.concat(x[0], F.lit(" - "), x[1])).otherwise(x[2]))

    link = F.get(F.filter(F.transform(offers, lambda o: o[0]), lambda u: u.isNotNull()), F.lit(0))
    return F.when(offers.isNull(), F.struct(F.lit("Free").alias("price"), url.alias("offer_url"))).when(
        F.size(offers) > 0, F.struct(price.display_range(F.transform(offers, amount)).alias("price"), link.alias("offer_url")))


def jsonld_location(node: Column) -> Column:
    """Struct (venue_name, venue_address) of a node's location."""
    def read(x: Column) -> Column:
        values = F.array(*_place_values(x["place"], x["address"]))
        return let(F.transform(values, coerce_text), lambda t: _place_said(x["place"], [t[k] for k in range(8)]))

    return let(_place(_get(node, "location")), lambda p: let(F.struct(p.alias("place"), _address(p).alias("address")), read))


def jsonld_price(node: Column) -> Column:
    """Struct (price, offer_url): one display text from a node's offers."""
    url = F.when(_free(node), coerce_text(_get(node, "url")))
    return let(let(_offers(node), lambda o: _offer_texts(node, o)), lambda t: _price_said(t, url))


def _drawn(nodes: DataFrame) -> DataFrame:
    """The nodes that have a title, with the texts of their fields, ``place`` and ``cost``.

    What is read more than once is a column of its own, so that it is computed once and needs no lambda.
    """
    node, place, address = F.col("node"), F.col("_place"), F.col("_address")
    read = nodes.withColumns({"_own": _node(node, *_OWN, kind="string"), "_place": _place(_get(node, "location")), "_offers": _offers(node)})
    read = read.withColumns({"_said": _node(place, "name", "url", kind="string"), "_address": _address(place)})
    read = read.withColumn("_parts", _node(address, *_ADDRESS, kind="string"))

    def field(key: str, other: str | None = None) -> tuple[Column, Column]:
        first = _filled(F.col("_own")[key])
        if other is None:
            return first, _get(node, key)
        return F.coalesce(first, _filled(F.col("_own")[other])), F.when(first.isNotNull(), _get(node, key)).otherwise(_get(node, other))

    pairs = [field("name"), field("url", "@id"), field("@id", "identifier"), field("description", "disambiguatingDescription"),
             field("startDate"), field("endDate"), field("image", "photo"), field("url"),
             *zip([F.col("_said.name"), F.col("_said.url"), *[F.col("_parts")[k] for k in _ADDRESS],
                   F.when(F.col("_parts").isNull(), _string(address)), F.when(~_holds(place), _string(place))], _place_values(place, address))]
    read = read.withColumns({f"_s{k}": s for k, (s, _) in enumerate(pairs)})
    strings = [F.col(f"_s{k}") for k in range(len(pairs))]
    read = read.withColumn("_deep", _deep_texts([(s, v) for s, (_, v) in zip(strings, pairs)]))
    names = ["_title", "_link", "_id", "_desc", "_start", "_end", "_image", "_url", *[f"_p{k}" for k in range(8)]]
    read = read.select(*nodes.columns, "_place", "_offers", *[t.alias(n) for n, t in zip(names, _texts(strings, F.col("_deep")))])
    # a generator keeps the filter on titles from computing the texts once more
    title = F.col("_title")
    read = read.withColumn("_title", F.explode(F.when(title.isNotNull(), F.array(title))))
    read = read.withColumns({"place": _place_said(place, [F.col(n) for n in names[8:]]), "_offers": _offer_texts(node, F.col("_offers"))})
    return read.withColumn("cost", _price_said(F.col("_offers"), F.col("_url"))).drop("_place", "_offers", "_url", *names[8:])


def jsonld_events(pages: DataFrame, as_of: str, source: str | None = None) -> DataFrame:
    """Listings from every event node that has a title.

    ``pages`` (page_id, url, html and, unless ``source`` is given, source).
    """
    label = F.lit(source) if source else F.col("source")
    node, page, now = F.col("node"), F.col("url"), dates.as_ntz(as_of)
    drawn = _drawn(jsonld_nodes(pages).select(label.alias("source"), "url", "page_id", "block", "node_pos", "node"))
    # what the calls of Python read more than once is a column, and all of them are made in one pass
    drawn = drawn.select("*", "place.*", "cost.*").withColumns({
        "_link": urls.joined(page, F.col("_link")), "_register": urls.joined(page, F.col("offer_url")), "_image": urls.joined(page, F.col("_image")),
        "_start": dates.event_text(F.col("_start")), "_end": dates.event_text(F.col("_end")), "_desc": text.strip_tags(F.col("_desc"))})
    drawn = drawn.withColumns({
        **{c: urls.resolved(page, F.col(c)) for c in ("_link", "_register", "_image")}, "_desc": text.unescape(F.col("_desc")),
        **{c: dates.read_event_text(F.col(c), now) for c in ("_start", "_end")}})
    listing = drawn.select(
        "source", F.coalesce("_id", "_link", page).alias("source_id"), F.coalesce("_link", page).alias("url"),
        F.col("_title").alias("title"), F.col("_desc").alias("description"), F.col("_start").alias("start_dt"), F.col("_end").alias("end_dt"),
        "venue_name", "venue_address", "price", F.col("_register").alias("register_url"), F.col("_image").alias("image_url"),
        structs.jsonable(F.struct(F.lit("json-ld").alias("_parser"), page.alias("_page_url"),
                                  F.to_json(node).alias("jsonld"))).alias("raw"),
        "page_id", "block", "node_pos")
    return filters.normalize_listing(conform(listing))
