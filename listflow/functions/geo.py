"""Distances and transit labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listflow import constants as K


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres between two points."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * (
        half_lon * half_lon)
    return 2 * K.EARTH_RADIUS_M * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def in_bounds(lat: Column, lon: Column) -> Column:
    """Whether a coordinate lies in the accepted box; null coordinates do not."""
    inside = lat.between(*K.BOUNDS["lat"]) & lon.between(*K.BOUNDS["lon"])
    return F.coalesce(inside, F.lit(False))


def route_mode(route_type: Column, label: Column) -> Column:
    """Mode of a route, or null when its type is not reported."""
    kind = F.trim(route_type.cast("string")).try_cast("int")
    rail = F.when(F.contains(F.lower(label), F.lit("streetcar")), F.lit("streetcar")).otherwise(
        F.lit("light_rail"))
    return F.when(kind.isin(*K.RAIL_ROUTE_TYPES), rail).when(
        kind.isin(*K.BUS_ROUTE_TYPES), F.lit("bus"))


def mode_rank(mode: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in K.MODE_PRIORITY.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, mode), F.lit(0))


def mode_of_rank(rank: Column) -> Column:
    out = F.lit(None).cast("string")
    for mode, value in K.MODE_PRIORITY.items():
        out = F.when(rank == value, F.lit(mode)).otherwise(out)
    return out


def natural_route_sort(routes: Column) -> Column:
    """Distinct labels: leading numbers in numeric order, then the rest A-Z."""
    lead = lambda r: F.regexp_extract(r, r"^\s*(\d+)", 1)
    keyed = F.transform(
        F.array_distinct(F.filter(routes, lambda r: r.isNotNull() & (r != ""))),
        lambda r: F.struct(
            F.when(lead(r) == "", 1).otherwise(0).alias("is_text"),
            F.coalesce(lead(r).try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias("n"),
            r.alias("label"),
        ),
    )
    return F.transform(F.array_sort(keyed), lambda s: s["label"])
