"""Same-event matching and entity resolution.

Matches are expressed as hub edges (member -> one record of its run) instead of pairs, so a
group of n alike records gives n edges, and the connected components are the same as those of
the full pair set. An edge may be listed more than once; components drop repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import text, urls
from listflow.session import cut_lineage

_SIGNATURE = ["day", "start", "role", "venue", "street", "title", "tokens", "url_key", "reg_key"]


def _minutes(n: int) -> Column:
    return F.expr(f"interval {n} minutes")


def match_keys(listings: DataFrame, id_col: str = "pos") -> DataFrame:
    """Columns the rules compare, one row per record.

    ``role`` keeps a sub-session (a record with ``parent_id``) apart from the listings it could
    be a part of.
    """
    role = F.col("parent_id").isNotNull() if "parent_id" in listings.columns else F.lit(False)
    return listings.select(
        F.col(id_col).alias("id"),
        F.to_date("start_dt").alias("day"),
        F.col("start_dt").alias("start"),
        role.alias("role"),
        text.venue_key(F.col("venue_name")).alias("venue"),
        text.street_key(F.col("venue_address")).alias("street"),
        text.name_key(F.col("title")).alias("title"),
        F.array_sort(text.title_tokens(F.col("title"))).alias("tokens"),
        urls.url_key(F.col("url")).alias("url_key"),
        urls.url_key(F.col("register_url")).alias("reg_key"),
    ).withColumn("untimed", F.date_format("start", "HH:mm:ss") == "00:00:00")


def collapse_copies(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(distinct records by everything the rules read, id -> representative id).

    The keys are computed once and kept in the shared folder. Identical copies are merged by a
    map-side aggregate, so a group of copies that holds a third of all rows is one node
    afterwards.
    """
    signed = cut_lineage(keyed.withColumn(
        "sig", F.sha2(F.to_json(F.struct(*_SIGNATURE)), 256)), "keys")
    reps = signed.groupBy("sig").agg(
        F.min("id").alias("id"), *[F.first(c).alias(c) for c in [*_SIGNATURE, "untimed"]])
    reps = cut_lineage(reps, "nodes")
    return reps.drop("sig"), (
        signed.select("id", "sig")
        .join(reps.select("sig", F.col("id").alias("rep")), "sig").drop("sig"))


def _hub_edges(members: DataFrame, keys: list[str], gap_minutes: int) -> DataFrame:
    """Link members of a block whose starts chain within the gap; an untimed start links all.

    Starts are first reduced to one row per distinct value, and blocks of one record dropped.
    The day is part of every block, so the ordered window only ever sees the distinct starts of
    one day; the hub of a run is the first record of its first start.
    """
    starts = members.groupBy(*keys, "start").agg(
        F.min("id").alias("first_id"), F.max("untimed").alias("untimed"), F.count("*").alias("n"))
    ordered = Window.partitionBy(*keys).orderBy("start")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("start").over(ordered)
    apart = before.isNull() | (F.col("start") - before > _minutes(gap_minutes)) & ~F.max("untimed").over(whole)
    runs = (
        starts.withColumns({"_opens": apart, "_size": F.sum("n").over(whole)}).filter("_size > 1")
        .withColumn("hub", F.last(F.when(F.col("_opens"), F.col("first_id")), True).over(so_far))
        .select(*keys, "start", "hub")
    )
    return (members.join(runs, [*keys, "start"])
            .filter(F.col("id") != F.col("hub"))
            .select(F.col("hub").alias("src"), F.col("id").alias("dst")))


def _key_members(nodes: DataFrame) -> DataFrame:
    """One row per record and normalized link it carries."""
    links = F.array(F.struct(F.lit("url").alias("kind"), F.col("url_key").alias("key")),
                    F.struct(F.lit("reg").alias("kind"), F.col("reg_key").alias("key")))
    return (
        nodes.withColumn("link", F.explode(F.filter(links, lambda x: x["key"].isNotNull())))
        .select("id", "day", "start", "role", "venue", "title", "untimed", "link.kind", "link.key")
    )


def _place_members(nodes: DataFrame) -> DataFrame:
    """One row per record, venue or street it has, and distinctive title word."""
    places = F.array(F.struct(F.lit("venue").alias("kind"), F.col("venue").alias("place")),
                     F.struct(F.lit("street").alias("kind"), F.col("street").alias("place")))
    return (
        nodes.withColumn("at", F.explode(F.filter(places, lambda p: p["place"].isNotNull())))
        .select("id", "day", "start", "role", "untimed", "at.kind", "at.place",
                F.explode("tokens").alias("token"))
    )


def match_auto(nodes: DataFrame) -> DataFrame:
    """Edges between dated records of one day with an equal url or registration url.

    Two records at one venue whose titles differ and whose starts are more than three hours
    apart are not linked directly; all others of the group are. Unless a group is limited to a
    single venue and a long day, every member is reachable from every other.
    """
    keys = ["kind", "key", "day", "role"]
    members = _key_members(nodes.filter("day is not null"))
    groups = members.groupBy(*keys).agg(
        F.min("id").alias("hub"), F.count("*").alias("n"),
        F.min("venue").alias("v0"), F.max("venue").alias("v1"),
        F.count_if(F.col("venue").isNull()).alias("no_venue"),
        F.max("untimed").alias("any_untimed"),
        (F.max("start") - F.min("start")).alias("spread"))
    limited = ((F.col("no_venue") == 0) & (F.col("v0") == F.col("v1")) & ~F.col("any_untimed")
               & (F.col("spread") > _minutes(K.NEVER_MERGE_MINUTES)))
    groups = cut_lineage(groups.filter("n > 1").select(*keys, "hub", limited.alias("limited")), "groups")
    free = members.join(groups.filter("not limited"), keys).filter("id <> hub").select(
        F.col("hub").alias("src"), F.col("id").alias("dst"))
    if groups.filter("limited").isEmpty():
        return free
    tight = members.join(groups.filter("limited").select(*keys), keys)
    titles = tight.groupBy(*keys, "title").agg(F.min("id").alias("hub"))
    same_title = tight.join(titles, [*keys, "title"]).filter(F.col("id") != F.col("hub")).select(
        F.col("hub").alias("src"), F.col("id").alias("dst"))
    close = _hub_edges(tight, keys, K.NEVER_MERGE_MINUTES)
    return free.unionByName(same_title).unionByName(close)


def match_standard(nodes: DataFrame) -> DataFrame:
    """Edges between records of one day and venue (or street) that share a distinctive title
    word and start within two hours of each other."""
    members = _place_members(nodes.filter("day is not null"))
    keys = ["kind", "place", "token", "day", "role"]
    return _hub_edges(members, keys, K.MATCH_MINUTES)


def never_merge(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Drop explicit edges that must not merge: different days, a session and a listing, or one
    venue with different titles more than three hours apart."""
    side = lambda a: nodes.select(
        F.col("id").alias(a), *[F.col(c).alias(f"{a}_{c}") for c in
                                ("day", "start", "role", "venue", "title", "untimed")])
    both = edges.join(side("src"), "src").join(side("dst"), "dst")
    apart = F.abs(F.timestamp_diff("SECOND", F.col("src_start"), F.col("dst_start"))) \
        > K.NEVER_MERGE_MINUTES * 60
    sessions = (
        (F.col("src_venue") == F.col("dst_venue"))
        & ~F.col("src_title").eqNullSafe(F.col("dst_title"))
        & apart & ~F.col("src_untimed") & ~F.col("dst_untimed"))
    bad = ((F.col("src_day") != F.col("dst_day")) | (F.col("src_role") != F.col("dst_role"))
           | sessions)
    return both.filter(~F.coalesce(bad, F.lit(False))).select("src", "dst")


def _unsettled(edges: DataFrame) -> int:
    """Nodes that keep the edges from being stars: two parents, or a parent that has one."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("id"), F.lit(1).alias("up")),
        F.struct(F.col("v").alias("id"), F.lit(0).alias("up")))).alias("e")).select("e.*")
    per = ends.groupBy("id").agg(F.sum("up").alias("up"), F.min("up").alias("low"))
    return per.filter("up > 1 or (up = 1 and low = 0)").agg(F.count("*")).first()[0]


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges``; the component is its smallest id.

    Alternating large-star and small-star rounds: each is two aggregates and two joins on edge
    rows, with no neighbour list ever gathered. Rounds are cut to files in the shared folder.
    """
    e = (edges.filter("src <> dst")
         .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    e = cut_lineage(e, "edges")
    if e.isEmpty():
        return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        e = cut_lineage(small, "edges")
        if not _unsettled(e):
            break
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def sessions_apart(placed: DataFrame) -> DataFrame:
    """(component, venue) that hold two different titles more than three hours apart.

    ``placed`` (component, venue, title, start) has timed records only. Each title is reduced to
    its earliest and latest start; the widest gap between two titles then involves either the
    title that starts first, or its latest start and the first start of the others.
    """
    at = ["component", "venue"]
    spans = placed.filter("venue is not null").groupBy(*at, "title").agg(
        F.min("start").alias("lo"), F.max("start").alias("hi"))
    opening = spans.groupBy(*at).agg(
        F.min(F.struct("lo", "title")).alias("_first"), F.count("*").alias("n")).filter("n > 1")
    own = F.col("title").eqNullSafe(F.col("_first.title"))
    ends = spans.join(opening, at).groupBy(*at).agg(
        F.min("_first.lo").alias("lo0"), F.max(F.when(own, F.col("hi"))).alias("hi0"),
        F.min(F.when(~own, F.col("lo"))).alias("lo1"), F.max(F.when(~own, F.col("hi"))).alias("hi1"))
    limit = _minutes(K.NEVER_MERGE_MINUTES)
    return ends.filter((F.col("hi1") - F.col("lo0") > limit) | (F.col("hi0") - F.col("lo1") > limit)).select(*at)


def _split_sessions(placed: DataFrame) -> DataFrame:
    """(id, component) in which no venue holds sessions that must stay apart.

    Where a chain of links has joined such sessions, the component's records at that venue are
    parted by title; the rest of the component stays together.
    """
    apart = sessions_apart(placed).withColumn("_apart", F.lit(True))
    parted = placed.join(apart, ["component", "venue"], "left").withColumn("part", F.coalesce(
        F.when(F.col("_apart"), F.to_json(F.struct("venue", "title"))), F.lit("")))
    names = parted.groupBy("component", "part").agg(F.min("id").alias("name"))
    return parted.join(names, ["component", "part"]).select("id", F.col("name").alias("component"))


def _attach(loose: DataFrame, settled: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Component of each loose record (id, keys) by the keys it shares with settled ones
    (id, keys), whose components are ``known``.

    It joins them when they are all in one component, stays alone when they are in several, and
    otherwise groups with the loose records it shares a key with. Loose records are written first,
    so that settled ones without a key of theirs drop out before they are joined to anything.
    """
    loose = cut_lineage(loose, "loose")
    asked = settled.join(loose.select(*keys).distinct(), keys, "left_semi").join(known, "id")
    reach = asked.groupBy(*keys).agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
    met = cut_lineage(loose.join(reach, keys, "left"), "met")
    verdict = met.groupBy("id").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1"))
    joined = verdict.filter("c0 is not null").select(
        "id", F.when(F.col("c0") == F.col("c1"), F.col("c0")).otherwise(F.col("id")).alias("component"))
    free = met.join(verdict.filter("c0 is null").select("id"), "id", "left_semi")
    hubs = free.groupBy(*keys).agg(F.min("id").alias("hub"))
    edges = free.join(hubs, keys).filter("id <> hub").select(
        F.col("hub").alias("src"), F.col("id").alias("dst"))
    return joined.unionByName(connected_components(edges))


def resolve_entities(listings: DataFrame, id_col: str = "pos") -> DataFrame:
    """(id, group_id) for every record; records that match nothing form their own group.

    Groups are made of records with a time of day first, so that a record without one never
    joins two of them: first the date-only records and then the undated ones are attached to
    the one group that they match. No group holds two sessions that :func:`never_merge` forbids.
    """
    nodes, copies = collapse_copies(match_keys(listings, id_col))
    timed = nodes.filter("day is not null and not untimed")
    linked = connected_components(match_auto(timed).unionByName(match_standard(timed)))
    placed = timed.select("id", "venue", "title", "start").join(linked, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    grouped = cut_lineage(_split_sessions(cut_lineage(placed, "placed")), "grouped")

    day_keys = ["kind", "key", "role", "day"]
    dated = nodes.filter("day is not null")
    at_place = F.concat_ws("|", "place", "token")
    hooks = _key_members(dated).select("id", "untimed", *day_keys).unionByName(
        _place_members(dated).withColumn("key", at_place).select("id", "untimed", *day_keys))
    date_only = _attach(hooks.filter("untimed").drop("untimed"),
                        hooks.filter("not untimed").drop("untimed"), grouped, day_keys)
    alone = dated.filter("untimed").select("id").join(date_only, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component"))
    known = cut_lineage(grouped.unionByName(alone), "dated")

    links = _key_members(nodes).select("id", "kind", "key", "role", "day")
    undated = _attach(links.filter("day is null").drop("day"),
                      links.filter("day is not null").drop("day"), known, ["kind", "key", "role"])
    return copies.join(known.unionByName(undated).withColumnRenamed("id", "rep"), "rep", "left").select(
        "id", F.coalesce("component", "rep").alias("group_id"))
