"""GTFS service roll-up and nearest stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import geo, text
from listflow.session import cut_lineage


def served_routes(routes: DataFrame) -> DataFrame:
    """Routes that have a label and a reported mode: (feed, route_id, label, mode_rank)."""
    short, long = (F.trim(F.coalesce(F.col(c), F.lit("")))
                   for c in ("route_short_name", "route_long_name"))
    label = F.coalesce(F.nullif(short, F.lit("")), F.nullif(long, F.lit("")))
    mode = geo.route_mode(F.col("route_type"), F.concat(short, F.lit(" "), long))
    return (
        routes.select("feed", F.trim("route_id").alias("route_id"), label.alias("label"),
                      geo.mode_rank(mode).alias("mode_rank"))
        .filter((F.col("route_id") != "") & F.col("label").isNotNull() & (F.col("mode_rank") > 0))
    )


def gtfs_service(routes: DataFrame, trips: DataFrame, stop_times: DataFrame,
                 stops: DataFrame) -> DataFrame:
    """Distinct (stop, route label, mode) rows for stops that have service.

    Trips are reduced to served ones before ``stop_times`` joins them, and the joined rows
    collapse to one per stop and label before stops are attached, so the millions of timetable
    rows meet one shuffle and a map-side combine.
    """
    trip_service = (
        trips.select("feed", F.trim("trip_id").alias("trip_id"), F.trim("route_id").alias("route_id"))
        .filter("trip_id <> ''").join(served_routes(routes), ["feed", "route_id"])
        .select("feed", "trip_id", "label", "mode_rank")
    )
    per_stop = (
        stop_times.select("feed", "trip_id", "stop_id").join(trip_service, ["feed", "trip_id"])
        .groupBy("feed", "stop_id", "label").agg(F.max("mode_rank").alias("mode_rank"))
    )
    named = stops.select(
        "feed", F.trim("stop_id").alias("stop_id"), F.trim("stop_name").alias("stop_name"),
        F.col("stop_lat").try_cast("double").alias("lat"),
        F.col("stop_lon").try_cast("double").alias("lon"),
    ).filter("stop_name <> '' and lat is not null and lon is not null")
    return per_stop.join(named, ["feed", "stop_id"])


def stop_rollup(service: DataFrame) -> DataFrame:
    """One row per stop: its distinct route labels in natural order and its best mode."""
    return (
        service.groupBy("feed", "stop_id", "stop_name", "lat", "lon")
        .agg(F.collect_set("label").alias("routes"), F.max("mode_rank").alias("_rank"))
        .select("feed", "stop_id", "stop_name", "lat", "lon",
                geo.natural_route_sort(F.col("routes")).alias("routes"),
                geo.mode_of_rank(F.col("_rank")).alias("mode"))
    )


def _stop_name_key(c: Column) -> Column:
    return text.collapse(F.lower(c))


def _collapse_stops(stops: DataFrame) -> DataFrame:
    """Stops of one name at one coordinate are one place; merge them before any radius join."""
    return (
        stops.withColumn("name_key", _stop_name_key(F.col("stop_name")))
        .groupBy("name_key", F.col("lat").alias("stop_lat"), F.col("lon").alias("stop_lon"))
        .agg(F.min("stop_name").alias("stop_name"),
             F.array_distinct(F.flatten(F.collect_set("routes"))).alias("routes"),
             F.max(geo.mode_rank(F.col("mode"))).alias("mode_rank"))
    )


def _cell_width(band: Column, side: float) -> Column:
    """Longitude width of a cell: the radius at the band edge nearest the pole."""
    edge = F.greatest(F.abs(band * side), F.abs((band + 1) * side))
    return side / F.greatest(F.cos(F.radians(F.least(edge, F.lit(89.9)))), F.lit(1e-6))


def within_radius(sites: DataFrame, stops: DataFrame, radius_m: float) -> DataFrame:
    """Site-stop pairs within the radius, as an equi-join on grid cells.

    Cells are one radius high and at least one radius wide, so a site needs its own cell only
    and every stop is listed in the nine cells around it. Sites are never replicated.
    """
    side = radius_m / K.METRES_PER_DEGREE
    site_band = F.floor(F.col("lat") / side)
    left = sites.withColumn("band", site_band).withColumn(
        "cell", F.floor(F.col("lon") / _cell_width(F.col("band"), side)))
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    right = (
        stops.withColumn("_b", F.explode(near))
        .withColumn("band", F.floor(F.col("stop_lat") / side) + F.col("_b"))
        .withColumn("_c", F.explode(near))
        .withColumn("cell", F.floor(F.col("stop_lon") / _cell_width(F.col("band"), side)) + F.col("_c"))
        .drop("_b", "_c")
    )
    box = (F.abs(F.col("stop_lat") - F.col("lat")) <= side) & (
        F.abs(F.col("stop_lon") - F.col("lon")) <= side / F.cos(F.radians("lat")))
    return (
        left.join(right, ["band", "cell"]).filter(box)
        .withColumn("distance", geo.haversine_m(
            F.col("lat"), F.col("lon"), F.col("stop_lat"), F.col("stop_lon")))
        .filter(F.col("distance") <= radius_m)
        .drop("band", "cell", "stop_lat", "stop_lon")
    )


def merge_stops_by_name(pairs: DataFrame, site: list[str]) -> DataFrame:
    """One row per site and stop name: the nearest instance, with the routes and best mode of
    every instance at most 400 m farther out; instances beyond that are another place."""
    key = [*site, "name_key"]
    nearest = F.min("distance").over(Window.partitionBy(*key))
    return (
        pairs.withColumn("_near", nearest)
        .filter(F.col("distance") - F.col("_near") <= K.STOP_MERGE_RADIUS_M)
        .groupBy(*key)
        .agg(F.min(F.struct("distance", "stop_name")).alias("_first"),
             F.flatten(F.collect_set("routes")).alias("routes"),
             F.max("mode_rank").alias("mode_rank"))
        .select(*site, F.col("_first.stop_name").alias("stop_name"),
                geo.natural_route_sort(F.col("routes")).alias("routes"),
                F.bround("_first.distance").cast("int").alias("distance_m"),
                geo.mode_of_rank(F.col("mode_rank")).alias("mode"))
    )


def topk_per_point(merged: DataFrame, site: list[str], k: int = 3) -> DataFrame:
    """The k nearest merged stops per site, as ``rank`` 1..k."""
    w = Window.partitionBy(*site).orderBy("distance_m", "stop_name")
    return merged.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def nearest_stops(points: DataFrame, stops: DataFrame, k: int = 3,
                  radius_m: float = K.SEARCH_RADIUS_M,
                  fallback_m: float = K.FALLBACK_RADIUS_M) -> DataFrame:
    """Nearest stops per point; the wide search runs only for points with none close by.

    Work is done once per distinct coordinate, so a venue that holds a third of all events
    costs one search, and results go back to points by coordinate. The stop table and the close
    pairs are read more than once, so each is kept in the shared folder.
    """
    site = ["lat", "lon"]
    places = cut_lineage(_collapse_stops(stops), "stops")
    sites = points.filter("lat is not null and lon is not null").select(*site).distinct()
    close = cut_lineage(within_radius(sites, places, radius_m), "close")
    rest = sites.join(close.select(*site).distinct(), site, "left_anti")
    pairs = close.unionByName(within_radius(rest, places, fallback_m))
    best = topk_per_point(merge_stops_by_name(pairs.repartition(*site), site), site, k)
    return points.join(best, site)


def transit_arrays(ranked: DataFrame, key: str) -> DataFrame:
    """At most k stops per key as one ordered array of structs."""
    entry = F.struct("rank", "stop_name", "routes", "distance_m", "mode")
    ordered = F.array_sort(F.collect_list(entry))
    return ranked.groupBy(key).agg(F.transform(
        ordered, lambda s: s.dropFields("rank")).alias("transit"))
