"""Survivorship on the written example, and its invariants."""

from pyspark.sql import functions as F

from listflow.operators import merging, verification

SCHEMA = ("group_id long, member_id string, source string, pos long, title string, description string, "
          "start_dt timestamp_ntz, end_dt timestamp_ntz, venue_name string, venue_address string, price string, "
          "register_url string, image_url string, url string, relevance_avg double")


def member(pos, source, title="", description=None, start=None, end=None, venue=None, address=None, price=None,
           register=None, image=None, url=None, group=1, score=None):
    import datetime as dt
    at = lambda s: dt.datetime.fromisoformat(s) if s else None
    return (group, f"{source}:{pos}", source, pos, title, description, at(start), at(end), venue, address, price,
            register, image, url or f"https://x.example/{pos}", score)


def test_written_example(spark):
    rows = [
        member(0, "do206", "Green Lake 5K", "Short.", "2026-08-22 00:00:00", price="$35-$40", venue="Greenlake", score=7.0),
        member(1, "eventbrite", "Green Lake Summer 5K", " ", "2026-08-22 09:00:00", "2026-08-22 12:00:00",
               "Green Lake Park", None, "$35", "https://tickets.example/e/1", score=8.3),
        member(2, "venue_site", "Summer 5K", "A flat, chip-timed 5K.", "2026-08-22 09:00:00", None, "Green Lake Park",
               "7201 E Green Lake Dr N, Seattle, WA 98115", None, None, "https://runners.example/5k.jpg"),
    ]
    members = spark.createDataFrame(rows, SCHEMA)
    got = merging.survivorship(members).first()
    assert (got["title"], got["price"], got["description"]) == ("Green Lake Summer 5K", "$35", "A flat, chip-timed 5K.")
    assert got["provenance"] == {
        "title": "eventbrite", "description": "venue_site", "start_dt": "eventbrite", "end_dt": "eventbrite",
        "venue_name": "eventbrite", "venue_address": "venue_site", "price": "eventbrite", "register_url": "eventbrite",
        "image_url": "venue_site", "url": "eventbrite"}
    summary = merging.group_summary(members).first()
    assert (summary["n_members"], summary["best_relevance"]) == (3, 8.3)


def test_ties_inside_a_source(spark):
    rows = [
        member(0, "reddit", "B", start="2026-08-22 00:00:00", address="9 Pier Rd", price="cheap"),
        member(1, "reddit", "A", start="2026-08-22 19:00:00", address="9 Pier Rd, Seattle", price="$10-$20"),
        member(2, "reddit", "C", start="2026-08-22 18:00:00", address="9 Pier", price="$15"),
        member(3, "unlisted", "D", price="$1", venue="Only here"),
    ]
    got = merging.survivorship(spark.createDataFrame(rows, SCHEMA)).first()
    assert got["title"] == "B" and str(got["start_dt"]) == "2026-08-22 19:00:00"
    assert got["venue_address"] == "9 Pier Rd, Seattle" and got["price"] == "$15" and got["venue_name"] == "Only here"
    assert "description" not in got["provenance"] and "image_url" not in got["provenance"]


def test_values_stay_verbatim(spark):
    got = merging.survivorship(spark.createDataFrame([member(0, "reddit", "  Odd   Title ")], SCHEMA)).first()
    assert got["title"] == "  Odd   Title "


def test_invariants_find_faults(spark):
    members = spark.createDataFrame([member(i, "reddit", f"T{i}", group=i % 2) for i in range(6)], SCHEMA)
    merged = merging.survivorship(members)
    sound = {r["rule"]: r["violations"] for r in merging.merge_invariants(members, members, merged).collect()}
    assert set(sound.values()) == {0}
    lost = members.filter("pos <> 5").unionByName(members.filter("pos = 1"))
    bad = merging.merge_invariants(members, lost, merged.withColumn("title", F.lit("made up")))
    found = {r["rule"]: r["violations"] for r in bad.collect()}
    assert found["missing"] == 1 and found["twice"] == 1 and found["altered_values"] == 2


def test_held_verdict(spark):
    events = spark.createDataFrame(
        [(1, "2026-08-22 09:00:00", "Green Lake Park", "7201 E Green Lake Dr N, Seattle", "$35", "eventbrite")],
        "event_id long, s string, venue_name string, venue_address string, price string, primary_source string"
    ).withColumn("start_dt", F.col("s").cast("timestamp_ntz")).drop("s")

    def verdict(*obs):
        df = spark.createDataFrame(list(obs), "event_id long, source string, fetch_ok boolean, s string, "
                                   "stated_venue string, stated_price string, status_flag string")
        df = df.withColumn("stated_start", F.col("s").cast("timestamp_ntz")).drop("s")
        return verification.verification_verdict(verification.cross_check(events, df), events).first()

    at, venue = "2026-08-22 09:00:00", "The Green Lake Park (north lot)"
    held = verdict((1, "eventbrite", True, at, venue, "$35", None), (1, "venue_site", True, at, venue, "$40 day of", None),
                   (1, "do206", False, None, None, None, None))
    assert (held["verdict"], held["date_agrees"], held["venue_agrees"], held["price_agrees"]) == ("HELD", True, True, False)
    assert verdict((1, "eventbrite", True, at, venue, "from $35", None))["verdict"] == "VERIFIED"
    assert verdict((1, "do206", True, at, venue, "$35", None))["verdict"] == "HELD"
    two = ((1, "do206", True, at, venue, "$35", None), (1, "reddit", True, "2026-08-22 09:10:00", venue, None, None))
    assert verdict(*two, (1, "eventbrite", True, None, None, None, None))["verdict"] == "VERIFIED"
    assert verdict(*two)["verdict"] == "HELD"  # nobody read the primary source
    unseen = verdict((2, "do206", True, at, venue, "$35", None))
    assert (unseen["event_id"], unseen["n_sources"], unseen["verdict"]) == (1, 0, "HELD")
    assert verdict((1, "eventbrite", True, at, venue, "$35", "sold_out"))["verdict"] == "HELD"
    assert verdict((1, "eventbrite", True, "2026-08-22 00:00:00", venue, "donation", None))["verdict"] == "HELD"


def test_unknown_sources_rank_by_host(spark):
    from listflow.operators.changes import source_priority
    rows = [("feed", "https://tickets.eventbrite.com/e/1", 0), ("feed", "https://www.parks.wa.gov:443/x", 2), ("x", "https://EverOut.com/a", 4),
            ("x", "https://old.reddit.com/r/Seattle", 6), ("x", "https://notseattle.gov/a", 7), ("x", "https://seattle.gov.example/a", 7),
            ("x", None, 7), (None, "", 7), ("reddit", "https://eventbrite.com/e", 6), ("venue_site", None, 1)]
    df = spark.createDataFrame(rows, "source string, url string, want int")
    assert all(r.want == r.got for r in df.withColumn("got", source_priority(F.col("source"), F.col("url"))).collect())
    members = spark.createDataFrame([
        (1, "a", "reddit", 0, "https://reddit.com/1", "Reddit"), (1, "b", "partner feed", 1, "https://tickets.eventbrite.com/e/1", "Eventbrite"),
        (1, "c", "venue_site", 2, "https://hall.example", "Hall")],
        "group_id long, member_id string, source string, pos long, url string, title string")
    best = merging.survivorship(members, ("title",)).first()
    assert best["title"] == "Eventbrite" and best["provenance"] == {"title": "partner feed"}
    ranks = {r["member_id"]: r["rank"] for r in merging.field_rank(members, "title").collect()}
    assert ranks == {"b": 1, "c": 2, "a": 3}


def test_rows_without_a_key_are_dealt_out(spark):
    from listflow.operators.lookups import lookup
    rows = spark.range(20000).selectExpr("id", "case when id % 2 = 0 then null else id % 500 end as k", "case when id % 3 = 0 then null else 1L end as j")
    table = spark.range(500).selectExpr("id as k", "1L as j", "id * 10 as v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = lookup(rows, table, "k", "j")
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] < 3 * sizes[len(sizes) // 2]
        want = {i: None if i % 2 == 0 or i % 3 == 0 else i % 500 * 10 for i in range(20000)}
        assert {r.id: r.v for r in out.collect()} == want and out.count() == 20000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
