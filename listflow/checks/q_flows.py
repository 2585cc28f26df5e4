"""Checked queries: whole flows and the streaming forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from listflow.checks.fixtures import AS_OF, spark_text
from listflow.checks.q_entities import _FIELDS, _RESOLVED, _best
from listflow.checks.q_gather import _AVG, _CLASS, _DEDUPED
from listflow.checks.registry import register
from listflow.checks.sqlparts import CONTENT_HASH, EXCLUDED, INCLUDED, NOW, PRIORITY, clean as sql_clean
from listflow.functions import keys
from listflow.operators import changes
from listflow.plans import clean, gather
from listflow.session import scratch_path
from listflow.sources import listings as src
from listflow.streaming import changes as st, slices

FP = ("listings", "fingerprints")
ALL = ("listings", "fingerprints", "scores")

_NORMAL = f"""nl as (select * replace (coalesce({sql_clean('source_id')}, trim(url)) as source_id, coalesce({sql_clean('title')}, '') as title, coalesce({sql_clean('description')}, '') as description,
  {sql_clean('venue_name')} as venue_name, {sql_clean('price')} as price) from listings)"""
_NEAR = f"start_dt >= {NOW} and start_dt <= {NOW} + interval 10 day"


def new_or_changed(t):
    landed = src.conform(t.listings)
    return gather.new_or_changed(landed, t.fingerprints, AS_OF).withColumn(
        "priority", changes.source_priority(F.col("source"))).select(
        "pos", "fingerprint", "change", "priority", "title", "start_dt", "venue_name", "price",
        F.array_join("keyword_groups", ",").alias("keyword_groups"))


@register("gather_new_or_changed", f"""
with {_NORMAL}, f1 as (select * from (select *, row_number() over (partition by source, source_id order by pos) as rn from nl) where rn = 1),
d as (select * from f1 where {_NEAR} and not {EXCLUDED} and {INCLUDED}), {_CLASS}
select pos, source || ':' || source_id as fingerprint, change, cast({PRIORITY} as int) as priority, title, cast(start_dt as varchar) as start_dt, venue_name, price,
  case when title like '%5K%' or title like '%Cycling%' or title like '%Bootcamp%' or title like '%Ride%' then 'fitness' when title like '%Yoga%' then 'wellness' else 'lifestyle' end as keyword_groups from c where change <> 'unchanged'""", FP)
def gather_new_or_changed(t):
    return new_or_changed(t)


_QUAL = f"""{_NORMAL}, d as (select * from (select *, row_number() over (partition by source, source_id order by pos) as rn from nl) where rn = 1), {_CLASS},
q as (select c.*, {_AVG} as relevance_avg from c left join scores s on s.fingerprint = c.source || ':' || c.source_id
  where {_NEAR} and not {EXCLUDED} and {INCLUDED} and change <> 'unchanged' and {_AVG} >= 7.0 and pass_flag)"""


@register("gather_next_state", f"""
with {_NORMAL}, d as (select * from (select *, row_number() over (partition by source, source_id order by pos) as rn from nl) where rn = 1), {_CLASS},
s as (select source || ':' || source_id as fingerprint, new_hash, change from c where {_NEAR} and not {EXCLUDED} and {INCLUDED}
  and (change = 'unchanged' or source || ':' || source_id in (select fingerprint from scores)))
select fingerprint, case when s.change is null then f.content_hash when s.change = 'unchanged' then f.content_hash else new_hash end as content_hash,
  cast(coalesce(first_seen, {NOW}) as varchar) as first_seen, cast(case when s.change is null then last_seen else {NOW} end as varchar) as last_seen from fingerprints f full join s using (fingerprint)""", ALL)
def gather_next_state(t):
    return gather.gather(src.conform(t.listings), t.fingerprints, t.scores, AS_OF)[1].drop("canonical_id")


def _candidates(t):
    return gather.gather(src.conform(t.listings), t.fingerprints, t.scores, AS_OF)[0]


_GROUPED = _RESOLVED.replace("as untimed from listings)", "as untimed from q)")


@register("clean_to_events", f"""
with recursive {_QUAL}, {_GROUPED}, m as (select q.*, group_id from q join groups on groups.id = q.pos),
e as (select group_id, {', '.join(f'{_best(f, f)} as {f}' for f in _FIELDS)}, count(*) as n_members, max(relevance_avg) as best_relevance from m group by group_id)
select 'evt_' || substr(sha256(trim(lower(title)) || '|' || coalesce(substr(cast(start_dt as varchar), 1, 16), '') || '|' || trim(lower(venue_name))), 1, 16) as event_id,
  title, description, cast(start_dt as varchar) as start_dt, venue_name, venue_address, price, register_url, url, n_members, best_relevance from e""", ALL)
def clean_to_events(t):
    events, _, _ = clean.clean(_candidates(t))
    return events.select("event_id", "title", "description", "start_dt", "venue_name", "venue_address", "price",
                         "register_url", "url", "n_members", "best_relevance")


@register("clean_fingerprint_updates", f"""
with recursive {_QUAL}, {_GROUPED}, m as (select q.*, group_id from q join groups on groups.id = q.pos),
e as (select group_id, {_best('title', 'title')} as title, {_best('start_dt', 'start_dt')} as start_dt, {_best('venue_name', 'venue_name')} as venue_name from m group by group_id)
select m.source || ':' || m.source_id as fingerprint, new_hash as content_hash,
  'evt_' || substr(sha256(trim(lower(e.title)) || '|' || coalesce(substr(cast(e.start_dt as varchar), 1, 16), '') || '|' || trim(lower(e.venue_name))), 1, 16) as canonical_id from m join e using (group_id)""", ALL)
def clean_fingerprint_updates(t):
    return clean.clean(_candidates(t))[2]


# --- streaming ----------------------------------------------------------------------------


def _stream(t, path, schema):
    return t.spark.readStream.schema(schema).parquet(path)


def _first_run(t):
    """What an earlier run landed: a part of the listings, some at another price."""
    return t.listings.filter("pos % 4 <> 0").withColumn(
        "price", F.expr("if(pos % 5 = 0, '$1', price)"))


def _two_runs(t, start):
    """Land the earlier part, run; land everything, run again on the same checkpoint."""
    landed, mark = scratch_path(t.spark, "landed"), scratch_path(t.spark, "mark")
    _first_run(t).write.mode("append").parquet(landed)
    start(_stream(t, landed, t.listings.schema), mark)
    t.listings.write.mode("append").parquet(landed)
    start(_stream(t, landed, t.listings.schema), mark)


_RUNS = f"""r1 as (select pos, source || ':' || source_id as fingerprint, {CONTENT_HASH.replace("coalesce(price, '')", "coalesce(case when pos % 5 = 0 then '$1' else price end, '')")} as h from listings where pos % 4 <> 0),
r2 as (select pos, source || ':' || source_id as fingerprint, {CONTENT_HASH} as h from listings),
f1 as (select fingerprint, min(pos) as pos, arg_min(h, pos) as h from r1 group by fingerprint), f2 as (select fingerprint, min(pos) as pos, arg_min(h, pos) as h from r2 group by fingerprint)"""


_CHANGED = f"""
with {_RUNS} select fingerprint, pos, 'new' as change, h as content_hash from f1
union all select f2.fingerprint, f2.pos, case when f1.h is null then 'new' else 'changed' end, f2.h from f2 left join f1 using (fingerprint) where f1.h is null or f1.h <> f2.h"""


@register("st1_stream_changes", _CHANGED, ("listings",))
def st1_stream_changes(t):
    state = scratch_path(t.spark, "state")
    empty = t.fingerprints.filter(F.lit(False))
    _two_runs(t, lambda s, mark: st.stream_changes(s, state, mark, empty, AS_OF))
    return st.read_changes(t.spark, state).drop("version")


@register("st1_stream_changes_keyed", _CHANGED, ("listings",))
def st1_stream_changes_keyed(t):
    out = scratch_path(t.spark, "changes")
    _two_runs(t, lambda s, mark: st.run_available(st.stream_changes_keyed(s), out, mark))
    return t.spark.read.parquet(out)


def _events_stream(t):
    """Listings as a stream over the events file, with the event's own time."""
    t.events
    raw = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    raw.createOrReplaceTempView("events_stream")
    sql = spark_text("listings").replace("select event_id as pos", "select event_id as pos, ts", 1).replace("from events", "from events_stream")
    return t.spark.sql(sql)


@register("st2_stream_dedupe", "select distinct source, source_id as source_key from listings", ("listings",))
def st2_stream_dedupe(t):
    stream = st.with_event_time(_events_stream(t), "ts", "365 days")
    deduped = st.stream_dedupe(stream).select("source", "source_key")
    path = st.run_available(deduped, scratch_path(t.spark, "deduped"), scratch_path(t.spark, "mark"))
    return t.spark.read.parquet(path)


@register("st3_stream_merge", f"""
with {_RUNS} select fingerprint, coalesce(f2.h, f1.h) as content_hash, 'once' as kept from f1 full join f2 using (fingerprint)""", ("listings",))
def st3_stream_merge(t):
    state = scratch_path(t.spark, "state")
    empty = t.fingerprints.filter(F.lit(False))
    _two_runs(t, lambda s, mark: st.stream_merge(s, state, mark, empty, st.merge_seen(AS_OF)))
    return slices.read(t.spark, state).select("fingerprint", "content_hash", F.lit("once").alias("kept"))


@register("st4_run_available", "select source, count(*) as n, count(start_dt) as n_dated from listings group by source", ("listings",))
def st4_run_available(t):
    rows = _events_stream(t).select("pos", "source", "start_dt")
    path = st.run_available(rows, scratch_path(t.spark, "copied"), scratch_path(t.spark, "mark"))
    return t.spark.read.parquet(path).groupBy("source").agg(
        F.count("*").alias("n"), F.count("start_dt").alias("n_dated"))


@register("st5_expire_late", """
with l as (select source || ':' || source_id as fingerprint, max(start_dt) as s from listings where start_dt is not null group by 1),
w as (select max(ts) - interval 1 hour as mark from events)
select fingerprint, 'tracked' as status from l union all select fingerprint, 'expired' from l, w where s - interval 2 day <= w.mark""", ("listings",))
def st5_expire_late(t):
    stream = st.with_event_time(_events_stream(t), "ts", "1 hour")
    path = st.run_available(st.expire_late(stream), scratch_path(t.spark, "expired"), scratch_path(t.spark, "mark"))
    return t.spark.read.parquet(path).select("fingerprint", "status")
