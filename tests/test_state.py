"""Snapshots, repeated runs, plans and streams."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from listflow.checks.fixtures import AS_OF, Tables
from listflow.operators import changes, filters, ranking, work
from listflow.plans import clean, gather
from listflow.session import scratch_path
from listflow.sources import listings as src
from listflow.streaming import changes as st, slices

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_second_run_of_the_same_input_finds_nothing(t):
    fresh = changes.with_keys(filters.dedupe_same_source(t.listings))
    first = changes.change_filter(fresh, t.fingerprints)
    assert first.count() > 0
    update = first.selectExpr("fingerprint", "content_hash", "cast(null as string) as canonical_id")
    state = changes.merge_fingerprints(t.fingerprints, update, AS_OF)
    assert changes.change_filter(fresh, state).isEmpty()


def test_merges_are_idempotent(t):
    update = changes.with_keys(filters.dedupe_same_source(t.listings)).selectExpr(
        "fingerprint", "content_hash", "concat('evt_', pos) as canonical_id")
    once = changes.merge_fingerprints(t.fingerprints, update, AS_OF)
    assert same(once, changes.merge_fingerprints(once, update, AS_OF))
    fresh = t.articles.select("article_id", "stage", "status")
    assert same(fresh, work.insert_articles(fresh, fresh))
    posts = t.published.select("post_id", "state", "slug")
    again = work.record_published(posts, posts.drop("state"))
    assert same(again, work.record_published(again, posts.drop("state")))


def test_whole_run_twice_creates_the_same_ids(t):
    candidates, state, _ = gather.gather(src.conform(t.listings), t.fingerprints, t.scores, AS_OF)
    events, articles, updates = clean.clean(candidates)
    assert articles.count() == events.count() > 0
    assert articles.select("article_id").distinct().count() == articles.count()
    linked = changes.merge_fingerprints(state, updates, AS_OF)
    later, _, report = gather.gather(src.conform(t.listings), linked, t.scores, AS_OF)
    assert later.isEmpty() and report.first()["qualified"] == 0
    assert same(articles, clean.clean(candidates)[1])


def test_unscored_listings_come_back_in_the_next_run(t):
    landed = src.conform(t.listings)
    _, state, first = gather.gather(landed, t.fingerprints, t.scores, AS_OF)
    waiting = first.first()["skipped_unscored"]
    assert waiting > 0
    later = gather.gather(landed, state, t.scores, AS_OF)[2].first()
    assert later["skipped_unscored"] == waiting and later["skipped_score"] == 0
    every = t.listings.selectExpr("source || ':' || source_id as fingerprint", "10 as category_fit", "10 as audience_fit",
                                  "10 as timeliness", "true as pass_flag").distinct()
    scored = gather.gather(landed, state, every, AS_OF)[2].first()
    assert scored["qualified"] == waiting and scored["skipped_unscored"] == 0


def test_first_look_is_a_part_of_the_whole_run(t):
    landed = src.conform(t.listings)
    looked = {r.pos for r in gather.new_or_changed(landed, t.fingerprints, AS_OF).select("pos").collect()}
    kept = {r.pos for r in gather.gather(landed, t.fingerprints, t.scores, AS_OF)[0].select("pos").collect()}
    assert kept <= looked


def test_rank_of_a_group_larger_than_a_task(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("g"),
                                   F.expr("(id * 7919) % 20011").alias("k"))
    got = ranking.rank_within(df, "g", [F.col("k")]).cache()
    for g, n in (("hot", 13333), ("cold", 6667)):
        rows = [r["rank"] for r in got.filter(F.col("g") == g).orderBy("k").collect()]
        assert rows == list(range(1, n + 1))


def test_window_reaches_the_scan(t, spark):
    path = src.write_snapshot(src.conform(t.listings), scratch_path(spark, "landed"), "r1")
    near = filters.lead_window(src.read_listings(spark, path), AS_OF).select("source", "start_dt")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(start_dt" in plan and "LessThanOrEqual(start_dt" in plan
    assert "ReadSchema: struct<source:string,start_dt:timestamp_ntz>" in plan


def test_first_per_key_is_limited_before_the_shuffle(t):
    plan = filters.dedupe_same_source(t.listings)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below


@pytest.mark.parametrize("name", [n for n in sorted(driver.queries()) if not n.startswith("st")])
def test_no_cross_join_or_row_udf(spark, name):
    plan = driver.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in plan


def test_stream_in_many_files_equals_one_batch(t, spark):
    landed, out, mark = (scratch_path(spark, x) for x in ("landed", "out", "mark"))
    t.listings.repartition(6).write.parquet(landed)
    stream = spark.readStream.schema(t.listings.schema).option("maxFilesPerTrigger", 2).parquet(landed)
    st.run_available(st.stream_changes_keyed(stream), out, mark)
    got = spark.read.parquet(out)
    fresh = changes.with_keys(filters.dedupe_same_source(t.listings))
    assert got.select("fingerprint").distinct().count() == fresh.count()
    news = got.filter("change = 'new'")
    assert news.count() == fresh.count()


def test_lost_checkpoint_goes_on_from_the_state(t, spark):
    landed, state, mark = (scratch_path(spark, x) for x in ("landed", "state", "mark"))
    t.listings.write.parquet(landed)
    stream = spark.readStream.schema(t.listings.schema).parquet(landed)
    empty = t.fingerprints.filter(F.lit(False))
    st.stream_changes(stream, state, mark, empty, AS_OF)
    assert slices.versions(spark, state) == [0]
    st.stream_changes(stream, state, mark, empty, AS_OF)
    assert slices.versions(spark, state) == [0]
    found = st.read_changes(spark, state).count()
    st.stream_changes(stream, state, scratch_path(spark, "mark"), empty, AS_OF)
    assert slices.versions(spark, state) == [0, 1]
    fresh = changes.with_keys(filters.dedupe_same_source(t.listings))
    assert same(slices.read(spark, state).select("fingerprint", "content_hash"), fresh.select("fingerprint", "content_hash"))
    assert st.read_changes(spark, state).count() == found == fresh.count()


def _upsert(current, batch):
    return current.join(batch, "k", "left_anti").unionByName(batch.filter("v <> 'gone'"))


def test_a_batch_rewrites_only_the_slices_of_its_keys(spark):
    path = scratch_path(spark, "state")
    initial = spark.range(2000).selectExpr("id as k", "'old' as v")
    batches = [spark.createDataFrame([(k, "new") for k in keys], "k long, v string") for keys in ([1], range(20), [], [3000, 1])]
    want = {k: "old" for k in range(2000)}
    for n, batch in enumerate(batches):
        assert slices.advance(path, initial, batch, batch, "k", _upsert, "run", n) == n
        want |= {r.k: r.v for r in batch.collect()}
        assert {r.k: r.v for r in slices.read(spark, path).collect()} == want
        rewritten = spark.read.schema("k long, v string, slice int").parquet(f"{path}/slices/version={n}").select("slice").distinct().count()
        touched = batch.select(slices.slice_of("k", slices.SLICES)).distinct().count()
        assert rewritten == (touched if n else slices.SLICES)
    # the last batch once more makes the same version, from the one before
    again = spark.createDataFrame([(5, "again")], "k long, v string")
    assert slices.advance(path, initial, again, again, "k", _upsert, "run", 3) == 3
    del want[3000]
    want |= {5: "again"}
    assert {r.k: r.v for r in slices.read(spark, path).collect()} == want
    assert {r.k: r.v for r in slices.read(spark, path, before=1).collect()}[5] == "old"


def test_slices_that_lose_all_rows(spark):
    path = scratch_path(spark, "state")
    initial = spark.createDataFrame([(1, "old"), (2, "old")], "k long, v string")
    for n, rows in enumerate(([(1, "gone")], [(2, "gone")], [], [(7, "new")])):
        batch = spark.createDataFrame(rows, "k long, v string")
        slices.advance(path, initial, batch, batch, "k", _upsert, "run", n)
    assert [tuple(r) for r in slices.read(spark, path).collect()] == [(7, "new")]
    assert slices.read(spark, path, before=3).count() == 0 and slices.read(spark, scratch_path(spark, "none")) is None


def test_repeated_keys_are_one_row(spark):
    current = spark.createDataFrame([("e1", "old", AS_OF, AS_OF)], "event_id string, title string, created_at string, updated_at string").selectExpr(
        "event_id", "title", "cast(created_at as timestamp_ntz) as created_at", "cast(updated_at as timestamp_ntz) as updated_at")
    twice = spark.createDataFrame([("e1", "b"), ("e1", "a"), ("e2", "c"), ("e2", "c")], "event_id string, title string")
    got = {r["event_id"]: r["title"] for r in work.merge_events(current, twice, AS_OF).collect()}
    assert got == {"e1": "b", "e2": "c"} and work.merge_events(current, twice, AS_OF).count() == 2
    fresh = spark.createDataFrame([("a1", "x"), ("a1", "y")], "article_id string, stage string")
    assert work.insert_articles(fresh.limit(0), fresh).count() == 1


def test_stream_and_batch_hash_alike(t, spark):
    row = src.conform(t.listings).limit(1).withColumn("venue_name", F.lit(" Hall  A "))
    batch = changes.with_keys(filters.normalize_listing(row)).first()["content_hash"]
    empty = t.fingerprints.filter(F.lit(False))
    assert st.merge_seen(AS_OF)(empty, row).first()["content_hash"] == batch
    assert st.change_step(AS_OF)(empty, row).first()["content_hash"] == batch


class _Held:
    """List state of one key, as a stateful processor sees it, counting the calls."""

    def __init__(self):
        self.rows, self.calls = [], 0

    def getListState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return iter([*self.rows])

    def put(self, rows):
        self.calls += 1
        self.rows = [*rows]

    def appendValue(self, row):
        self.calls += 1
        self.rows.append(row)


def test_keys_of_a_bucket_share_the_exchanges_with_the_state():
    held, processor, known = _Held(), st._Changes(), {}
    processor.init(held)
    for n in range(120):
        rows = [(7, f"a:{k}", pos, f"h{(n * k // 50 + pos) % 5}") for k in (range(40) if n % 30 == 0 else [n % 50]) for pos in (1, 0)]
        want = {f: (p, h) for _, f, p, h in rows if p == 0 and known.get(f) != h}
        held.calls = 0
        got = [*processor.handleInputRows((7,), iter(rows), None)]
        assert {r.fingerprint: (r.pos, r.content_hash) for r in got} == want and len(got) == len(want)
        assert all(r.change == ("changed" if r.fingerprint in known else "new") for r in got)
        known |= {f: h for f, (_, h) in want.items()}
        assert held.calls == (2 if want else 1)
        assert len(held.rows) <= 16 and sum(len(s[0]) for s in held.rows) <= 2 * len(known)


def test_keyed_changes_of_buckets_with_many_keys(t, spark, monkeypatch):
    monkeypatch.setattr(st, "_BUCKETS", 3)
    landed, out, mark = (scratch_path(spark, x) for x in ("landed", "out", "mark"))
    fields = "source string, source_id string, pos long, price string"
    blank = [F.lit(None).cast("string").alias(c) for c in ("url", "title", "description", "venue_name", "venue_address", "register_url", "image_url")]
    many = [("b", str(k), 100 + k, "$5") for k in range(40)]
    big = 2**60 + 1
    runs = [
        ([("a", "1", 5, "$2"), ("a", "1", 1, "$1"), (None, "2", 2, "$1"), ("a", "3", None, "$1"), ("a", "4", big, "$1"), ("a", "4", big, "$1"), *many],
         {("a:1", 1, "new"), (None, 2, "new"), ("a:3", None, "new"), ("a:4", big, "new"), *((f"b:{k}", 100 + k, "new") for k in range(40))}),
        ([("a", "1", 1, "$2"), (None, "2", 2, "$1"), ("a", "3", 0, "$9"), ("a", "3", None, "$1"), *many], {("a:1", 1, "changed")}),
        ([("a", "1", 1, "$1"), (None, "2", 3, "$8"), ("b", "7", 7, None), ("c", "1", 8, "$1")],
         {("a:1", 1, "changed"), (None, 3, "changed"), ("b:7", 7, "changed"), ("c:1", 8, "new")}),
        ([("a", "1", 1, "$1"), ("b", "7", 7, None), *many[8:]], set()),
    ]
    before = Counter()
    for rows, want in runs:
        listings = spark.createDataFrame(rows, fields).select("*", F.lit(None).cast("timestamp_ntz").alias("start_dt"), *blank)
        listings.coalesce(1).write.mode("append").parquet(landed)
        st.run_available(st.stream_changes_keyed(spark.readStream.schema(listings.schema).parquet(landed)), out, mark)
        found = Counter(map(tuple, spark.read.parquet(out).select("fingerprint", "pos", "change", "content_hash").collect()))
        assert Counter(r[:3] for r in (found - before).elements()) == Counter(want)
        before = found
