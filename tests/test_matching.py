"""Sparse matching and resolution against a pair-by-pair reading of the rules."""

import datetime as dt
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from listflow.operators import matching

SCHEMA = ("pos long, url string, register_url string, title string, venue_name string, venue_address string, "
          "start_dt timestamp_ntz, parent_id string")


def rows(seed, n=160):
    rng = random.Random(seed)
    out = []
    for pos in range(n):
        day = dt.datetime(2026, 5, rng.choice([1, 1, 2]))
        minutes = rng.choice([0, 540, 600, 690, 810, 960, 1200])
        out.append((
            pos, f"https://h.example/{rng.randrange(60)}", rng.choice([None, f"http://r.example/{rng.randrange(40)}?x"]),
            rng.choice(["Rowing Sprint", "Rowing Regatta", "Canoe Regatta", "Kite Jam", "Free Run"]),
            rng.choice([None, "Boathouse", "The Boathouse", "Pier"]), rng.choice([None, "12 Dock St, Seattle", "9 Pier Rd"]),
            rng.choice([None, day, day + dt.timedelta(minutes=minutes), day + dt.timedelta(minutes=minutes)]),
            rng.choice([None] * 6 + ["p1"])))
    return out


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def components(ids, pairs):
    parent = {i: i for i in ids}
    for a, b in pairs:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {i: find(parent, i) for i in ids}


def must_stay_apart(a, b):
    gap = abs((a["start"] - b["start"]).total_seconds()) / 60
    return bool(a["venue"] and a["venue"] == b["venue"] and a["title"] != b["title"] and gap > 180
                and not a["untimed"] and not b["untimed"])


def alike(a, b):
    """Whether two dated records are linked directly."""
    if a["day"] != b["day"] or a["role"] != b["role"]:
        return False
    gap = abs((a["start"] - b["start"]).total_seconds()) / 60
    timed = not a["untimed"] and not b["untimed"]
    place = any(a[k] and a[k] == b[k] for k in ("venue", "street"))
    words = set(a["tokens"]) & set(b["tokens"])
    return (share_link(a, b) and not must_stay_apart(a, b)) or bool(place and words and (gap <= 120 or not timed))


def share_link(a, b):
    return a["role"] == b["role"] and any(a[k] and a[k] == b[k] for k in ("url_key", "reg_key"))


def attach(loose, settled, comp, linked):
    """The one component whose records a loose record is linked to, alone if several, else among the loose."""
    out, free = {}, []
    for u in loose:
        near = {comp[d["id"]] for d in settled if linked(u, d)}
        if near:
            out[u["id"]] = near.pop() if len(near) == 1 else u["id"]
        else:
            free.append(u)
    pairs = [(a["id"], b["id"]) for a, b in combinations(free, 2) if linked(a, b)]
    return {**out, **components([u["id"] for u in free], pairs)}


def expected(nodes):
    timed = [n for n in nodes if n["day"] and not n["untimed"]]
    comp = components([n["id"] for n in timed],
                      [(a["id"], b["id"]) for a, b in combinations(timed, 2) if alike(a, b)])
    broken = {(comp[a["id"]], a["venue"]) for a, b in combinations(timed, 2)
              if comp[a["id"]] == comp[b["id"]] and must_stay_apart(a, b)}
    comp = {n["id"]: (comp[n["id"]], *((n["venue"], n["title"]) if (comp[n["id"]], n["venue"]) in broken else ()))
            for n in timed}
    date_only = [n for n in nodes if n["day"] and n["untimed"]]
    comp = {**comp, **attach(date_only, timed, comp, alike)}
    return {**comp, **attach([n for n in nodes if not n["day"]], timed + date_only, comp, share_link)}


def partition(groups):
    out = {}
    for i, g in groups.items():
        out.setdefault(g, set()).add(i)
    return sorted(map(sorted, out.values()))


def test_resolution_equals_pairwise_rules(spark):
    for seed in (1, 2, 3):
        df = spark.createDataFrame(rows(seed), SCHEMA)
        nodes = [r.asDict() for r in matching.match_keys(df).collect()]
        got = {r["id"]: r["group_id"] for r in matching.resolve_entities(df).collect()}
        assert partition(got) == partition(expected(nodes)), seed
        by = {n["id"]: n for n in nodes}
        assert not any(must_stay_apart(by[a], by[b]) for a, b in combinations(by, 2)
                       if got[a] == got[b] and by[a]["day"] and by[b]["day"])


def test_a_date_only_listing_does_not_join_sessions(spark):
    at = lambda h, m=0: dt.datetime(2026, 5, 1, h, m)
    sessions = [(1, "https://h.example/1", "https://r.example/fest", "Morning Paddle", "Pier", None, at(9), None),
                (2, "https://h.example/2", "https://r.example/fest", "Lantern Parade", "Pier", None, at(14), None)]
    festival = [(3, "https://h.example/3", "https://r.example/fest", "Harbor Fest", None, None, at(0), None)]
    got = {r["id"]: r["group_id"] for r in matching.resolve_entities(
        spark.createDataFrame(sessions + festival, SCHEMA)).collect()}
    assert got == {1: 1, 2: 2, 3: 3}
    one = {r["id"]: r["group_id"] for r in matching.resolve_entities(
        spark.createDataFrame(sessions[:1] + festival, SCHEMA)).collect()}
    assert one == {1: 1, 3: 1}


def test_a_chain_over_three_hours_is_parted_by_title(spark):
    at = lambda h, m=0: dt.datetime(2026, 5, 1, h, m)
    chain = [(1, "https://h.example/1", None, "Rowing Sprint", "Pier", None, at(9), None),
             (2, "https://h.example/2", None, "Rowing Regatta", "Pier", None, at(10, 45), None),
             (3, "https://h.example/3", None, "Rowing Finals", "Pier", None, at(12, 40), None)]
    got = {r["id"]: r["group_id"] for r in matching.resolve_entities(spark.createDataFrame(chain, SCHEMA)).collect()}
    assert got == {1: 1, 2: 2, 3: 3}


@pytest.mark.parametrize("minutes, one_title, n_groups", [(600, False, 3000), (150, False, 1), (600, True, 1)])
def test_edges_stay_linear_in_a_hot_group(spark, minutes, one_title, n_groups):
    n = 3000
    title = F.lit("Rowing Regatta") if one_title else F.concat(F.lit("Rowing Regatta "), F.col("id"))
    df = spark.range(n).select(
        F.col("id").alias("pos"), F.lit("https://h.example/hot").alias("url"), F.lit(None).cast("string").alias("register_url"),
        title.alias("title"), F.lit("Pier").alias("venue_name"),
        F.lit("9 Pier Rd").alias("venue_address"),
        F.expr("timestamp_ntz'2026-05-01 08:00:00' + make_dt_interval(0, 0, cast(id % " + str(minutes) + " as int))").alias("start_dt"))
    nodes = matching.match_keys(df)
    # two words shared by all (plus one of its own) at two kinds of place
    assert matching.match_standard(nodes).count() <= 4 * n
    assert matching.match_auto(nodes).count() <= 2 * n
    assert matching.resolve_entities(df).select("group_id").distinct().count() == n_groups


def test_identical_copies_are_one_node(spark):
    df = spark.createDataFrame([(i, *rows(1, 1)[0][1:]) for i in range(500)], SCHEMA)
    nodes, copies = matching.collapse_copies(matching.match_keys(df))
    assert nodes.count() == 1 and copies.count() == 500


def test_weekly_series_is_not_merged_by_a_shared_link(spark):
    weekly = [(i, f"https://h.example/{i}", "https://r.example/club", "Rowing Club", "Pier", None,
               dt.datetime(2026, 5, 1, 9) + dt.timedelta(weeks=i), None) for i in range(6)]
    undated = [(99, "https://h.example/99", "https://r.example/club", "Rowing Club", None, None, None, None)]
    got = matching.resolve_entities(spark.createDataFrame(weekly + undated, SCHEMA)).collect()
    assert {r["id"]: r["group_id"] for r in got} == {**{i: i for i in range(6)}, 99: 99}


def test_components_of_a_long_chain(spark):
    n = 400
    order = list(range(n))
    random.Random(5).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)], "src long, dst long")
    got = matching.connected_components(edges)
    assert got.count() == n and got.select("component").distinct().collect()[0][0] == 0


def test_sparse_checkpoint_folder_is_the_sessions(spark):
    from listflow import session
    assert session.scratch_path(spark, "x").startswith(session.shared_dir(spark))


def test_attached_records_meet_only_settled_ones_with_their_keys(spark):
    at = lambda *rows: spark.createDataFrame([(i, "url", k) for i, k in rows], "id long, kind string, key string")
    loose = at((1, "a"), (2, "a"), (2, "b"), (3, "z"), (4, "z"), (5, "a"), (5, "a"), (6, None))
    settled = at((10, "a"), (11, "a"), (12, "b"), (12, "b"), (13, "unasked"), (14, None), (15, "a"))
    known = spark.createDataFrame([(10, 10), (11, 10), (12, 12), (13, 13), (14, 14)], "id long, component long")
    got = sorted((r["id"], r["component"]) for r in matching._attach(loose, settled, known, ["kind", "key"]).collect())
    assert got == [(1, 10), (2, 2), (3, 3), (4, 3), (5, 10)]
