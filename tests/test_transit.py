"""Nearest stops against a plain scan over all stops."""

import math
import random

from listflow.operators import transit
from listflow.sources import gtfs

R = 6371008.8
RANK = {"bus": 1, "streetcar": 2, "light_rail": 3}


def metres(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    x = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(x))


def scan(lat, lon, stops, k=3):
    for radius in (1500, 5000):
        found = []
        for name, slat, slon, routes, mode in stops:
            if abs(slat - lat) > radius / 111320 or abs(slon - lon) > radius / (111320 * math.cos(math.radians(lat))):
                continue
            d = metres(lat, lon, slat, slon)
            if d <= radius:
                found.append((d, name, routes, mode))
        if found:
            break
    merged = {}
    for d, name, routes, mode in sorted(found):
        key = " ".join(name.lower().split())
        if key not in merged:
            merged[key] = [d, name, set(routes), mode]
        elif d - merged[key][0] <= 400:
            merged[key][2] |= set(routes)
            merged[key][3] = max(merged[key][3], mode, key=RANK.get)
    out = sorted((round(d), name, mode, frozenset(r)) for d, name, r, mode in merged.values())
    return out[:k]


def test_equals_a_scan_at_several_latitudes(spark):
    rng = random.Random(7)
    for centre in (47.6, -33.9, 0.0, 68.0):
        stops = [(f"Stop {rng.randrange(60)}", centre + rng.uniform(-.08, .08), -122.3 + rng.uniform(-.08, .08),
                  [str(rng.randrange(9))], rng.choice(list(RANK))) for _ in range(250)]
        points = [(i, centre + rng.uniform(-.12, .12), -122.3 + rng.uniform(-.12, .12)) for i in range(40)]
        s = spark.createDataFrame([("f", *x) for x in stops], "feed string, stop_name string, lat double, lon double, routes array<string>, mode string")
        got = {}
        for r in transit.nearest_stops(spark.createDataFrame(points, "point_id long, lat double, lon double"), s).collect():
            got.setdefault(r["point_id"], []).append((r["distance_m"], r["stop_name"], r["mode"], frozenset(r["routes"])))
        assert {i: sorted(v) for i, v in got.items()} == {i: w for i, a, b in points if (w := scan(a, b, stops))}


def test_feed_headers_and_unserved_stops(spark, tmp_path):
    feed = tmp_path / "metro"
    feed.mkdir()
    (feed / "routes.txt").write_text("﻿route_id, route_short_name,route_long_name,route_type\nr1,7,Rainier,3\nr2,,First Hill Streetcar,0\nr3,9,Ferry,4\n", encoding="utf-8")
    (feed / "trips.txt").write_text("route_id,service_id,trip_id\nr1,w,t1\nr2,w,t2\nr3,w,t3\n")
    (feed / "stop_times.txt").write_text("trip_id,arrival_time,stop_id\nt1,08:00,a\nt2,08:00,a\nt3,08:00,b\nt1,08:05,c\n")
    (feed / "stops.txt").write_text("stop_id,stop_name,stop_lat,stop_lon\na,Pine St,47.61,-122.33\nb,Pier,47.60,-122.34\nc,Nowhere,x,-122.3\n")
    t = gtfs.gtfs_read(spark, {"metro": str(feed)})
    rows = transit.stop_rollup(transit.gtfs_service(t["routes"], t["trips"], t["stop_times"], t["stops"])).collect()
    assert [(r["stop_id"], r["routes"], r["mode"]) for r in rows] == [("a", ["7", "First Hill Streetcar"], "streetcar")]
