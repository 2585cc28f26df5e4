"""Coordinates, neighborhoods, images and transit for merged events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import geo, text
from listflow.operators import transit
from listflow.operators.lookups import lookup
from listflow.session import cut_lineage, dimension

#: Aliases accepted on read, nested then flat; the result always has the first flat name.
ALIASES = {
    "venue_name": ("venue", ["name"], ["venue_name"]),
    "venue_address": ("venue", ["address", "street_address"], ["venue_address", "address"]),
    "venue_url": ("venue", ["url", "website"], ["venue_url", "venue_website"]),
    "lat": ("venue", ["lat", "latitude"], ["lat", "latitude", "venue_lat"]),
    "lon": ("venue", ["lon", "lng", "longitude"], ["lon", "lng", "longitude", "venue_lon"]),
    "image_url": ("image", ["url"], ["image_url"]),
    "image_alt": ("image", ["alt", "alt_text"], ["image_alt"]),
    "image_source": ("image", ["source"], ["image_source"]),
    "neighborhood": (None, [], ["neighborhood", "neighbourhood"]),
}


#: Columns that may hold an event's stored stops, the first filled one counts; text is read as JSON.
TRANSIT_ALIASES = ["transit_json", "transit", "transit_stops"]


def flatten_aliases(events: DataFrame) -> DataFrame:
    """Flat canonical columns from whichever nested or flat aliases the events carry."""
    types = dict(events.dtypes)
    nested = {g for g in ("venue", "image") if types.get(g, "").startswith("struct")}
    made, used = {}, set(nested)
    for name, (group, inner, flat) in ALIASES.items():
        kind = "double" if name in ("lat", "lon") else "string"
        if group in nested:
            have = {f.name for f in events.schema[group].dataType.fields}
            cols = [F.col(f"{group}.{k}") for k in inner if k in have]
        else:
            cols = [F.col(k) for k in flat if k in types]
            used.update(k for k in flat if k in types)
            if name == "venue_name" and types.get("venue") == "string":
                cols.append(text.clean_text(F.col("venue")))
                used.add("venue")
        cols = [F.when(c.cast("string") != "", c).try_cast(kind) for c in cols]
        made[name] = F.coalesce(*cols) if cols else F.lit(None).cast(kind)
    keep = [c for c in events.columns if c not in used and c not in ALIASES]
    return events.select(*keep, *[c.alias(n) for n, c in made.items()])


def geocode_key(name: Column, address: Column) -> Column:
    """Lowercase lookup text "name, address"; the city is added when it is not there."""
    n, a = text.clean_text(name), text.clean_text(address)
    query = F.concat(n, F.lit(", "), F.coalesce(a, F.lit("Seattle, WA")))
    low = F.lower(query)
    local = F.contains(low, F.lit("seattle")) | F.array_contains(F.split(low, text.SPACES), "wa")
    return F.when(local, low).otherwise(F.concat(low, F.lit(", seattle, wa")))


def geocode_lookup(venues: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Add ``found_lat`` and ``found_lon`` from a gazetteer (query, lat, lon).

    A hit outside the accepted box is no hit, and nothing is guessed. Of rows whose queries are
    equal in lower case, the one with the least coordinates counts, so venues are not repeated.
    """
    known = gazetteer.filter(geo.in_bounds(F.col("lat"), F.col("lon"))).select(
        F.lower("query").alias("_q"), F.round("lat", 6).alias("found_lat"),
        F.round("lon", 6).alias("found_lon"))
    known = known.groupBy("_q").agg(F.min(F.struct("found_lat", "found_lon")).alias("_at")).select("_q", "_at.*")
    keyed = venues.withColumn("_q", geocode_key(F.col("venue_name"), F.col("venue_address")))
    return lookup(keyed, known, "_q").drop("_q")


def library_frame(spark: SparkSession) -> DataFrame:
    """The stock image library as a dimension table (key, name, url, description)."""
    rows = dimension(spark, K.IMAGE_LIBRARY, ["name", "url", "description"])
    return rows.withColumn("key", text.name_key(F.col("name")))


def alias_frame(spark: SparkSession) -> DataFrame:
    return dimension(spark, list(K.NEIGHBORHOOD_ALIASES.items()), ["key", "alias_of"])


def canonical_neighborhood(df: DataFrame, name: str, library: DataFrame, aliases: DataFrame,
                           into: str = "canonical") -> DataFrame:
    """Library name for a free-form neighborhood: library key first, then alias, else null."""
    lib = library.filter("name <> 'default'").select(
        F.col("key").alias("_k"), F.col("name").alias("_lib"))
    other = aliases.select(F.col("key").alias("_k"), F.col("alias_of").alias("_alias"))
    return (
        df.withColumn("_k", text.name_key(F.col(name)))
        .join(lib, "_k", "left").join(other, "_k", "left")
        .withColumn(into, F.coalesce("_lib", "_alias")).drop("_k", "_lib", "_alias")
    )


def neighborhood_of(places: DataFrame, library: DataFrame, aliases: DataFrame) -> DataFrame:
    """Neighborhood of a reverse-geocoded address: first filled field, canonical when known.

    Addresses in another city give null.
    """
    have = set(places.columns)
    city = text.first_value(*[F.col(c) for c in K.CITY_FIELDS if c in have])
    local = city.isNull() | F.contains(F.lower(city), F.lit("seattle"))
    raw = text.first_value(*[F.col(c) for c in K.NEIGHBORHOOD_FIELDS if c in have])
    named = places.withColumn("_raw", F.when(local, F.trim(raw)))
    return canonical_neighborhood(named, "_raw", library, aliases).withColumn(
        "neighborhood", F.coalesce("canonical", "_raw")).drop("_raw", "canonical")


def build_alt(description: Column, neighborhood: Column) -> Column:
    """Alt text that says the picture is illustrative."""
    base = F.coalesce(
        text.clean_text(description),
        F.concat(F.lit("Street view in "), neighborhood, F.lit(", Seattle.")),
        F.lit("View of Seattle."))
    ended = F.when(F.rlike(base, F.lit(r"[.!?]$")), base).otherwise(F.concat(base, F.lit(".")))
    return F.concat(ended, F.lit(" " + K.IMAGE_DISCLAIMER))


def stock_image(df: DataFrame, library: DataFrame, aliases: DataFrame,
                neighborhood: str = "neighborhood") -> DataFrame:
    """Add ``stock_url`` and ``stock_alt``: the neighborhood's picture, else the default one,
    whose alt text does not name the neighborhood; no default gives an empty url."""
    entry = library.filter("name <> 'default' and trim(url) <> ''").select(
        F.col("key").alias("_e"), F.trim("url").alias("_url"), F.col("description").alias("_desc"))
    default = library.filter("name = 'default'")
    default_url = default.agg(F.first(F.trim("url"))).scalar()
    default_text = default.agg(F.first("description")).scalar()
    named = canonical_neighborhood(df, neighborhood, library, aliases, "_canon")
    label = F.coalesce("_canon", F.nullif(F.trim(F.col(neighborhood)), F.lit("")))
    keyed = named.withColumn("_e", text.name_key(F.coalesce("_canon", neighborhood))).join(
        entry, "_e", "left")
    own = F.col("_url").isNotNull()
    return (
        keyed.withColumn("stock_url", F.coalesce(F.col("_url"), default_url, F.lit("")))
        .withColumn("stock_alt", F.when(own, build_alt(F.col("_desc"), label)).otherwise(
            build_alt(default_text, F.lit(None).cast("string"))))
        .drop("_e", "_url", "_desc", "_canon")
    )


def enrich_events(events: DataFrame, gazetteer: DataFrame, places: DataFrame, photos: DataFrame,
                  stops: DataFrame, library: DataFrame, aliases: DataFrame) -> DataFrame:
    """Fill what the sources left empty: coordinates, neighborhood, image, transit.

    Existing values are never overwritten and unknown ones stay null. ``places`` is a
    reverse-geocode table on coordinates rounded to four digits (lat4, lon4, address fields);
    ``photos`` holds pictures per venue_url; of repeated keys the least value counts.
    """
    flat = flatten_aliases(events)
    stored = [c for c in TRANSIT_ALIASES if c in flat.columns]
    found = geocode_lookup(flat, gazetteer)
    missing = F.col("lat").isNull() | F.col("lon").isNull()
    hit = F.col("found_lat").isNotNull()
    placed = found.withColumns({
        "lat": F.when(missing & hit, F.col("found_lat")).otherwise(F.col("lat")),
        "lon": F.when(missing & hit, F.col("found_lon")).otherwise(F.col("lon")),
    }).drop("found_lat", "found_lon")
    areas = neighborhood_of(places, library, aliases).groupBy("lat4", "lon4").agg(
        F.min("neighborhood").alias("_area"))
    located = (
        lookup(placed.withColumns({"lat4": F.round("lat", 4), "lon4": F.round("lon", 4)}), areas, "lat4", "lon4")
        .withColumn("neighborhood", F.coalesce("neighborhood", "_area"))
        .drop("lat4", "lon4", "_area")
    )
    located = cut_lineage(located, "located")
    pictures = photos.groupBy("venue_url").agg(F.min("photo_url").alias("_photo"))
    shown = stock_image(lookup(located, pictures, "venue_url"), library, aliases)
    no_image = F.col("image_url").isNull()
    venue_photo = F.col("venue_name").isNotNull() & F.col("_photo").isNotNull()
    stock = F.nullif(F.col("stock_url"), F.lit(""))
    alt = F.when(venue_photo, F.concat(F.lit("Image from the website of "), F.col("venue_name"),
                                       F.lit("."))).when(stock.isNotNull(), F.col("stock_alt"))
    origin = F.when(venue_photo, "venue_site").when(stock.isNotNull(), "stock_neighborhood")
    pictured = shown.withColumns({
        "image_alt": F.when(no_image, F.coalesce(F.col("image_alt"), alt)).otherwise(F.col("image_alt")),
        "image_source": F.when(no_image, F.coalesce(F.col("image_source"), origin)).otherwise(
            F.col("image_source")),
        "image_url": F.when(no_image, F.when(venue_photo, F.col("_photo")).otherwise(stock)).otherwise(
            F.col("image_url")),
    }).drop("_photo", "stock_url", "stock_alt")
    sites = located.filter("lat is not null and lon is not null").select("lat", "lon").distinct()
    ranked = transit.nearest_stops(sites, stops).withColumn("_site", F.struct("lat", "lon"))
    near = transit.transit_arrays(ranked, "_site").select(
        F.col("_site.lat").alias("lat"), F.col("_site.lon").alias("lon"),
        F.col("transit").alias("_stops"))
    out = lookup(pictured, near, "lat", "lon")
    kinds, shape = dict(out.dtypes), dict(near.dtypes)["_stops"]
    given = [F.from_json(c, shape) if kinds[c] == "string" else F.col(c) for c in stored]
    given = [F.when(F.size(c) > 0, c) for c in given]
    others = [c for c in stored if c != "transit"]
    return out.withColumn("transit", F.coalesce(*given, F.col("_stops"))).drop("_stops", *others)
