"""Checked queries: GTFS service and nearest stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from listflow.checks.registry import register
from listflow.checks.sqlparts import HAVERSINE
from listflow.functions import geo
from listflow.operators import transit
from listflow.session import scratch_path
from listflow.sources import gtfs

G = ("gtfs_routes", "gtfs_trips", "gtfs_stop_times", "gtfs_stops")

SERVED = """served as (
  select feed, route_id, coalesce(nullif(trim(route_short_name), ''), nullif(trim(route_long_name), '')) as label,
    case when try_cast(route_type as int) in (0, 1, 2, 12) then case when contains(lower(route_short_name || ' ' || route_long_name), 'streetcar') then 2 else 3 end
      when try_cast(route_type as int) in (3, 11) then 1 end as mode_rank from gtfs_routes),
service as (
  select st.stop_id, s.stop_name, s.stop_lat as lat, s.stop_lon as lon, r.label, max(r.mode_rank) as mode_rank
  from gtfs_stop_times st join gtfs_trips t on t.trip_id = st.trip_id join served r on r.route_id = t.route_id and r.mode_rank is not null
  join gtfs_stops s on s.stop_id = st.stop_id group by all)"""
MODE = "case {} when 3 then 'light_rail' when 2 then 'streetcar' when 1 then 'bus' end"
ROUTES = r"""array_to_string(list_transform(list_sort(list_transform(list_distinct({}), lambda r: {{
  'a': case when regexp_matches(r, '^\s*\d') then 0 else 1 end, 'b': coalesce(try_cast(regexp_extract(r, '^\s*(\d+)', 1) as bigint), 0), 'c': r}})), lambda x: x.c), '|')"""
STOPS = f"""{SERVED}, stops as (select stop_id, stop_name, lat, lon, list(distinct label) as labels, max(mode_rank) as mode_rank from service group by all)"""


def tables(t):
    return t.gtfs_routes, t.gtfs_trips, t.gtfs_stop_times, t.gtfs_stops


def stops(t):
    return transit.stop_rollup(transit.gtfs_service(*tables(t)))


@register("s8_gtfs_read", """
select 'routes' as member, count(*) as n, count(distinct route_id) as n_keys from gtfs_routes
union all select 'trips', count(*), count(distinct trip_id) from gtfs_trips
union all select 'stop_times', count(*), count(distinct trip_id) from gtfs_stop_times
union all select 'stops', count(*), count(distinct stop_id) from gtfs_stops""", G)
def s8_gtfs_read(t):
    folder = scratch_path(t.spark, "gtfs")
    for member, df in zip(("routes", "trips", "stop_times", "stops"), tables(t)):
        df.drop("feed").write.csv(f"{folder}/{member}.txt", header=True)
    read = gtfs.gtfs_read(t.spark, {"metro": folder})
    key = {"routes": "route_id", "trips": "trip_id", "stop_times": "trip_id", "stops": "stop_id"}
    out = None
    for member, df in read.items():
        row = df.agg(F.lit(member).alias("member"), F.count("*").alias("n"),
                     F.countDistinct(key[member]).alias("n_keys"))
        out = row if out is None else out.unionByName(row)
    return out


@register("j6_gtfs_service", f"with {SERVED} select stop_id, stop_name, lat, lon, label, mode_rank from service", G)
def j6_gtfs_service(t):
    return transit.gtfs_service(*tables(t)).drop("feed")


@register("a1_stop_rollup", f"with {STOPS} select stop_id, stop_name, {ROUTES.format('labels')} as routes, {MODE.format('mode_rank')} as mode from stops", G)
def a1_stop_rollup(t):
    return stops(t).select("stop_id", "stop_name", F.array_join("routes", "|").alias("routes"), "mode")


@register("f17_haversine_m", f"""
with p as (select c_custkey, 47.50 + (c_custkey % 17) * 0.01e0 as lat, -122.40 + (c_custkey % 13) * 0.01e0 as lon, 47.6062e0 as qlat, -122.3321e0 as qlon from customer)
select c_custkey, cast(round({HAVERSINE.format(a='', b='q')}) as bigint) as metres from p""")
def f17_haversine_m(t):
    p = t.customer.selectExpr("c_custkey", "47.50 + (c_custkey % 17) * 0.01e0 as lat",
                              "-122.40 + (c_custkey % 13) * 0.01e0 as lon")
    d = geo.haversine_m(F.col("lat"), F.col("lon"), F.lit(47.6062), F.lit(-122.3321))
    return p.select("c_custkey", F.round(d).cast("bigint").alias("metres"))


@register("f18_route_mode", f"with {SERVED} select route_id, {MODE.format('mode_rank')} as mode from served", G)
def f18_route_mode(t):
    label = F.concat_ws(" ", "route_short_name", "route_long_name")
    return t.gtfs_routes.select("route_id", geo.route_mode(F.col("route_type"), label).alias("mode"))


@register("t3_natural_route_sort", f"""
with g as (select p_size, list(label) as labels from (select p_size, p_name as label from part union all select p_size, cast(p_partkey as varchar) || case when p_partkey % 3 = 0 then ' Express' else '' end from part) group by p_size)
select p_size, {ROUTES.format('labels')} as routes from g""")
def t3_natural_route_sort(t):
    labels = t.part.select("p_size", F.explode(F.array(
        "p_name", F.expr("concat(p_partkey, if(p_partkey % 3 = 0, ' Express', ''))"))).alias("label"))
    return labels.groupBy("p_size").agg(F.collect_set("label").alias("ls")).select(
        "p_size", F.array_join(geo.natural_route_sort(F.col("ls")), "|").alias("routes"))


_PAIRS = f"""{STOPS},
near as (select point_id, p.lat as plat, p.lon as plon, s.*, {HAVERSINE.format(a='p.', b='s.')} as d from points p join stops s
  on abs(s.lat - p.lat) <= 5000 / 111320.0e0 and abs(s.lon - p.lon) <= 5000 / (111320.0e0 * cos(radians(p.lat)))),
ring1 as (select * from near where d <= 1500 and abs(lat - plat) <= 1500 / 111320.0e0 and abs(lon - plon) <= 1500 / (111320.0e0 * cos(radians(plat)))),
cand as (select * from ring1 union all select * from near where d <= 5000 and point_id not in (select point_id from ring1)),
anch as (select *, min(d) over (partition by point_id, lower(stop_name)) as d0 from cand),
merged as (select point_id, lower(stop_name) as k, min(stop_name) as stop_name, flatten(list(labels)) as labels, max(mode_rank) as mode_rank, min(d) as d from anch where d - d0 <= 400 group by all),
ranked as (select *, cast(round_even(d, 0) as int) as distance_m, row_number() over (partition by point_id order by cast(round_even(d, 0) as int), stop_name) as rank from merged)"""


@register("a2_merge_stops_by_name", f"with {_PAIRS} select point_id, stop_name, {ROUTES.format('labels')} as routes, distance_m, {MODE.format('mode_rank')} as mode from ranked", G + ("points",))
def a2_merge_stops_by_name(t):
    site = ["lat", "lon"]
    places = transit._collapse_stops(stops(t))
    close = transit.within_radius(t.points.select(*site).distinct(), places, 1500.0)
    rest = t.points.select(*site).distinct().join(close.select(*site).distinct(), site, "left_anti")
    pairs = close.unionByName(transit.within_radius(rest, places, 5000.0))
    merged = transit.merge_stops_by_name(pairs, site)
    return t.points.join(merged, site).select(
        "point_id", "stop_name", F.array_join("routes", "|").alias("routes"), "distance_m", "mode")


@register("j7_nearest_stops", f"with {_PAIRS} select point_id, rank, stop_name, {ROUTES.format('labels')} as routes, distance_m, {MODE.format('mode_rank')} as mode from ranked where rank <= 3", G + ("points",))
def j7_nearest_stops(t):
    return transit.nearest_stops(t.points, stops(t)).select(
        "point_id", F.col("rank").cast("bigint").alias("rank"), "stop_name",
        F.array_join("routes", "|").alias("routes"), "distance_m", "mode")


@register("w3_topk_per_point", """
select n_regionkey, n_name, rank from (select n_regionkey, n_name, row_number() over (partition by n_regionkey order by bal, n_name) as rank
  from (select n_regionkey, n_name, cast(round(sum(c_acctbal)) as bigint) as bal from customer join nation on c_nationkey = n_nationkey group by all)) where rank <= 3""")
def w3_topk_per_point(t):
    per = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .groupBy("n_regionkey", "n_name").agg(F.round(F.sum("c_acctbal")).cast("bigint").alias("distance_m")))
    return transit.topk_per_point(per.withColumnRenamed("n_name", "stop_name"), ["n_regionkey"], 3).select(
        "n_regionkey", F.col("stop_name").alias("n_name"), F.col("rank").cast("bigint").alias("rank"))
