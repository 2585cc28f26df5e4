"""Checked queries: work queue, snapshots, sweeps and publishing slots."""

from __future__ import annotations

from pyspark.sql import functions as F

from listflow import constants as K
from listflow.checks.fixtures import AS_OF
from listflow.checks.registry import register
from listflow.checks.sqlparts import NOW, q
from listflow.functions import structs
from listflow.operators import slots, work

A = ("articles",)
AE = ("articles", "article_events")

OUTCOMES = """select article_id, case cast(floor(event_id / 5) as bigint) % 7 when 0 then 'infra' when 1 then 'held' when 2 then 'ok' when 3 then 'ok' when 4 then 'dropped' else 'fail' end as kind, case when event_id % 2 = 0 then 'weak' end as reason,
  case when stage = 's4_write' then null else 's4_write' end as retry_from from articles where status in ('queued', 'in_progress')"""


def with_attempts(t):
    return t.articles.withColumn("attempts", F.when(
        F.col("attempt_count") > 0, F.create_map("stage", "attempt_count", F.lit("s7_eic_note"), F.lit(1)))).withColumn(
        "hold_reason", F.lit(None).cast("string"))


@register("j16_work_queue", "select article_id, event_id, status, cast(start_dt as varchar) as start_dt from articles join article_events using (event_id) where status in ('queued', 'in_progress')", AE)
def j16_work_queue(t):
    return work.work_queue(t.articles, t.article_events).select("article_id", "event_id", "status", "start_dt")


@register("t1_next_articles", """
select article_id, relevance_avg, cast(start_dt as varchar) as start_dt from articles join article_events using (event_id) where status in ('queued', 'in_progress')
order by relevance_avg desc nulls last, start_dt asc nulls first, article_id limit 5""", AE)
def t1_next_articles(t):
    return work.next_articles(t.articles, t.article_events).select("article_id", "relevance_avg", "start_dt")


@register("t4_hold_queue", "select article_id, cast(updated_at as varchar) as updated_at from articles where status = 'held' order by updated_at, article_id", A)
def t4_hold_queue(t):
    return work.hold_queue(t.articles).select("article_id", "updated_at")


@register("t4_live_queue", "select post_id, cast(event_start_dt as varchar) as event_start_dt from published where state = 'live'", ("published",))
def t4_live_queue(t):
    return work.live_queue(t.published).select("post_id", "event_start_dt")


@register("t5_by_id", "select article_id, event_id, stage from articles where article_id = 'art_7'", A)
def t5_by_id(t):
    return work.by_id(t.articles, "article_id", "art_7").select("article_id", "event_id", "stage")


_CUR = "select real_id as event_id, min(title) as title, min(price) as price, cast('2024-01-02 00:00:00' as {TS}) as created_at, cast('2024-01-02 00:00:00' as {TS}) as updated_at from listings where real_id % 3 <> 0 group by real_id"
_UPD = "select real_id as event_id, max(title) || '!' as title from listings where real_id % 2 = 0 group by real_id"


def _events_state(t):
    t.listings
    return t.spark.sql(_CUR.replace("{TS}", "timestamp_ntz")), t.spark.sql(_UPD)


_CURD = _CUR.replace("{TS}", "timestamp")


@register("m3_merge_events", f"""
with c as ({_CURD}), u as ({_UPD}) select event_id, case when u.title is not null then u.title else c.title end as title, case when u.title is not null then null else c.price end as price,
  cast(coalesce(c.created_at, {NOW}) as varchar) as created_at, cast(case when u.title is not null then {NOW} else c.updated_at end as varchar) as updated_at from c full join u using (event_id)""", ("listings",))
def m3_merge_events(t):
    return work.merge_events(*_events_state(t), AS_OF)


@register("m3_merge_events_keep", f"""
with c as ({_CURD}), u as ({_UPD}) select event_id, coalesce(u.title, c.title) as title, c.price as price,
  cast(coalesce(c.created_at, {NOW}) as varchar) as created_at, cast(case when u.title is not null then {NOW} else c.updated_at end as varchar) as updated_at from c full join u using (event_id)""", ("listings",))
def m3_merge_events_keep(t):
    return work.merge_events(*_events_state(t), AS_OF, keep_existing=True)


_FRESH = """select 'evt_' || cast(real_id as string) as event_id, substr({SHA}(min(title)), 1, 16) as content_hash, cast(max(pos % 11) as double) as best_relevance from listings group by real_id"""


@register("m4_insert_articles", f"""
with f as (select 'art_' || substr(sha256(event_id || '|' || content_hash), 1, 12) as article_id, event_id, best_relevance from ({_FRESH.replace('{SHA}', 'sha256')}) x),
old as (select article_id, event_id, 's4_write' as stage, 'in_progress' as status, 1.0::double as relevance_avg from f where cast(best_relevance as int) % 2 = 0)
select * from old union all select article_id, event_id, 's3_validate', 'queued', best_relevance from f where article_id not in (select article_id from old)""", ("listings",))
def m4_insert_articles(t):
    t.listings
    fresh = work.new_articles(t.spark.sql(_FRESH.replace("{SHA}(", "listflow_sha(")))
    old = fresh.filter("cast(relevance_avg as int) % 2 = 0").select(
        "article_id", "event_id", F.lit("s4_write").alias("stage"), F.lit("in_progress").alias("status"), F.lit(1.0).alias("relevance_avg"))
    return work.insert_articles(old, fresh)


@register("m5_patch_articles", f"""
select article_id, case when event_id % 4 = 0 then 'archived' else status end as status, case when event_id % 4 = 0 then null else hold_stage end as hold_stage,
  cast(case when event_id % 4 = 0 then {NOW} else updated_at end as varchar) as updated_at from articles""", A)
def m5_patch_articles(t):
    patches = t.articles.filter("event_id % 4 = 0").select(
        "article_id", F.lit("archived").alias("status"), F.lit(None).cast("string").alias("hold_stage"))
    return work.patch_articles(t.articles, patches, AS_OF).select("article_id", "status", "hold_stage", "updated_at")


_NEXT = "case stage " + " ".join(f"when {q(a)} then {q(b)}" for a, b in zip(K.STAGES, K.STAGES[1:])) + " end"


@register("m6_transition", f"""
with o as ({OUTCOMES}), j as (select a.*, o.kind, o.reason, coalesce(o.retry_from, 's4_write') as retry, attempt_count + 1 as n, {_NEXT} as nxt from articles a left join o using (article_id)),
k as (select *, kind = 'fail' and n >= 3 as spent from j)
select article_id, case when kind = 'ok' and nxt is not null then nxt when kind = 'fail' and not spent then retry else stage end as stage,
  case when kind = 'ok' then case when nxt is null then 'scheduled' else 'in_progress' end when kind = 'held' or spent then 'held' when kind in ('fail', 'infra') then 'queued' when kind = 'dropped' then 'dropped' else status end as status,
  cast(case when kind = 'fail' then n else attempt_count end as int) as n_attempts, case when kind = 'held' or spent then stage else hold_stage end as hold_stage,
  case when spent then 'failed ' || n || ' attempts: ' || coalesce(reason, 'stage returned not-ok') when kind = 'held' then reason end as hold_reason from k""", A)
def m6_transition(t):
    t.articles
    moved = work.transition(with_attempts(t), t.spark.sql(OUTCOMES))
    ran = t.articles.select("article_id", F.col("stage").alias("ran"))
    return moved.join(ran, "article_id").select(
        "article_id", "stage", "status", F.coalesce(F.try_element_at("attempts", F.col("ran")), F.lit(0)).alias("n_attempts"),
        "hold_stage", "hold_reason")


@register("a8_run_metrics", f"""
with o as ({OUTCOMES}), r as (select 'run_' || (length(article_id) % 3) as run_id, case when kind = 'ok' then 'published' when kind = 'infra' then 'error' when kind = 'fail' then 'scheduled' else kind end as kind from o)
select run_id, count(*) filter (kind <> 'error') as processed, count(*) filter (kind = 'published') as published, count(*) filter (kind = 'scheduled') as scheduled,
  count(*) filter (kind = 'dropped') as dropped, count(*) filter (kind = 'held') as holds, count(*) filter (kind = 'error') as failures from r group by run_id""", A)
def a8_run_metrics(t):
    t.articles
    runs = t.spark.sql(OUTCOMES).selectExpr(
        "concat('run_', length(article_id) % 3) as run_id",
        "case when kind = 'ok' then 'published' when kind = 'infra' then 'error' when kind = 'fail' then 'scheduled' else kind end as kind")
    return work.run_metrics(runs)


_REVIEW = "select article_id, case when event_id % 3 = 0 then ' approved ' when event_id % 3 = 1 then 'REJECTED' end as review_status from articles"


@register("m7_approval_sweep", f"""
with j as (select a.*, status = 'held' and event_id % 3 = 0 as go, coalesce(reholds, 0) + 1 as again from articles a)
select article_id, case when go and again <= 2 then hold_stage else stage end as stage, case when go and again <= 2 then 'queued' when go then 'archived' else status end as status,
  case when go and again <= 2 then again else reholds end as reholds, case when go and again <= 2 then null else hold_stage end as hold_stage,
  case when go and again <= 2 then case when stage <> hold_stage and attempt_count > 0 then 2 when attempt_count > 0 then 1 else 0 end when attempt_count > 0 then 2 else -1 end as n_counters from j""", A)
def m7_approval_sweep(t):
    t.articles
    return work.approval_sweep(with_attempts(t), t.spark.sql(_REVIEW)).select(
        "article_id", "stage", "status", "reholds", "hold_stage",
        F.coalesce(F.size("attempts"), F.lit(-1)).alias("n_counters")).withColumn(
        "n_counters", F.when(F.col("n_counters").isNull(), -1).otherwise(F.col("n_counters")))


_SEEN = "select distinct event_id, case when event_id % 4 = 0 then 'Cancelled' when event_id % 4 = 1 then 'sold_out' when event_id % 4 = 2 then 'on sale' end as observed from published"


@register("m8_post_publish_sweep", f"""
with s as ({_SEEN}), j as (select p.*, case when state = 'live' then case when event_start_dt < {NOW} + interval 9 day then 'ended' when lower(observed) in ('cancelled', 'sold_out') then lower(observed) end end as ns from published p left join s using (event_id))
select post_id, event_id, coalesce(ns, state) as state, case ns when 'ended' then 'This event has ended.' when 'cancelled' then 'This event was cancelled.' when 'sold_out' then 'This event is sold out.' end as banner from j""", ("published",))
def m8_post_publish_sweep(t):
    t.published
    return work.post_publish_sweep(t.published, t.spark.sql(_SEEN), "2024-01-17 08:00:00").select(
        "post_id", "event_id", "state", "banner")


@register("m9_record_published", """
select post_id, case when event_id % 2 = 0 then 'live' else state end as state, case when event_id % 2 = 0 then slug || '-2' else slug end as slug from published
union all select 'post_' || article_id, 'live', 'slug-' || article_id from articles where status = 'scheduled'""", ("published",))
def m9_record_published(t):
    again = t.published.filter("event_id % 2 = 0").withColumn("slug", F.concat("slug", F.lit("-2")))
    fresh = t.articles.filter("status = 'scheduled'").selectExpr(
        "concat('post_', article_id) as post_id", "article_id", "event_id", "concat('slug-', article_id) as slug", "publish_at as event_start_dt")
    return work.record_published(t.published, again.drop("state").unionByName(fresh)).select("post_id", "state", "slug")


@register("f24_attempt_counters", """
select article_id, attempt_count + 1 as bumped, case when attempt_count > 0 then 1 else 0 end as n_after_reset from articles""", A)
def f24_attempt_counters(t):
    a = with_attempts(t)
    return a.select("article_id", structs.attempt_bump(F.col("attempts"), F.col("stage"))[F.col("stage")].alias("bumped"),
                    F.size(structs.attempt_reset(F.col("attempts"), F.col("stage"))).alias("n_after_reset"))


# --- slots --------------------------------------------------------------------------------

_BANDS = "(values " + ", ".join(
    f"({r}, {a}, {b}, {m}, {list(d)})" for r, a, b, m, d in K.SLOT_BANDS) + ") bands(band, first, last, mid, days)"
_OFFSETS = "(values " + ", ".join(
    f"({o}, {w})" for o, w in [*((o, 0) for o in K.PREFERRED_OFFSETS), *((o, i + 1) for i, o in enumerate(K.WIDENED_OFFSETS))]) + ") offs(offset_days, widening)"
_SLOTS = f"""starts as (select distinct start_dt from article_events),
days as (select start_dt, offset_days, widening, cast(start_dt as date) - offset_days as day from starts, {_OFFSETS}),
grid as (select *, unnest(range(first, last + 1, 15)) as minute from days join {_BANDS} on list_contains(days, isodow(day))),
cand as (select *, cast(day as timestamp) + to_minutes(cast(minute as int)) as slot, abs(minute - mid) as off_mid from grid),
legal as (select * from cand where slot >= {NOW} + interval 2 hour and slot <= start_dt - interval 24 hour and not (isodow(day) = 5 and minute >= 900) and minute < 1320 and minute > 329),
qq as (select distinct publish_at from articles where status = 'scheduled'),
gaps as (select slot, min(abs(date_diff('minute', slot, publish_at))) as gap from (select distinct slot from legal) l join qq on abs(date_diff('minute', slot, publish_at)) < 1440 group by slot),
sp as (select legal.*, gap as gap_minutes, case when gap is null then 24 when gap >= 720 then 12 when gap >= 360 then 6 end as spacing_hours from legal left join gaps using (slot)),
best as (select * from (select *, row_number() over (partition by start_dt order by widening, spacing_hours desc, band, abs(offset_days - 6), day, off_mid, slot) as rn from sp where spacing_hours is not null) where rn = 1)"""


def queue(t):
    return t.articles.filter("status = 'scheduled'").select("publication", "publish_at")


@register("j13_slot_spacing", f"""
with {_SLOTS} select cast(start_dt as varchar) as start_dt, cast(slot as varchar) as slot, band, gap_minutes, spacing_hours from sp""", AE)
def j13_slot_spacing(t):
    starts = t.article_events.select("start_dt").distinct()
    return slots.slot_spacing(slots.slot_candidates(starts, AS_OF), queue(t)).select(
        "start_dt", "slot", "band", "gap_minutes", "spacing_hours")


_DATED = "(select event_id, start_dt from article_events where event_id % 50 <> 49)"


@register("w5_rank_slots", f"""
with {_SLOTS}, lim as (select start_dt, start_dt - interval 24 hour as lim from starts),
ld as (select start_dt, lim, unnest([cast(lim as date), cast(lim as date) - 1]) as day from lim),
lg as (select start_dt, lim, cast(day as timestamp) + to_minutes(cast(unnest(range(first, last + 1, 15)) as int)) as slot, day from ld join {_BANDS} on list_contains(days, isodow(day))),
lr as (select start_dt, max(slot) as latest from lg where slot <= lim and not (isodow(day) = 5 and slot >= cast(day as timestamp) + interval 15 hour) group by start_dt)
select article_id, case when start_dt is not null then cast(coalesce(slot, case when latest >= {NOW} + interval 2 hour then latest else {NOW} + interval 2 hour end) as varchar) end as publish_at, band, offset_days, spacing_hours,
  case when start_dt is not null then coalesce(widening > 0, true) end as widened, case when start_dt is not null then slot is null end as lead_window_missed
from articles left join {_DATED} using (event_id) left join best using (start_dt) left join lr using (start_dt)""", AE)
def w5_rank_slots(t):
    starts = t.article_events.filter("event_id % 50 <> 49").select("event_id", "start_dt")
    dated = t.articles.select("article_id", "event_id").join(starts, "event_id", "left")
    return slots.rank_slots(dated, queue(t), AS_OF).select(
        "article_id", "publish_at", "band", "offset_days", "spacing_hours", "widened", "lead_window_missed")


def _turns(n):
    """One block of CTEs per turn: each publication's next article against queue and earlier picks."""
    out = []
    for i in range(1, n + 1):
        taken = " union all ".join(["select publication, publish_at from articles where status = 'scheduled'"] + [
            f"select publication, publish_at from pick{k}" for k in range(1, i)])
        out.append(f"""taken{i} as (select distinct publication, publish_at from ({taken}) x),
gap{i} as (select a.publication, l.start_dt, l.slot, min(abs(date_diff('minute', l.slot, publish_at))) as gap from turns a join legal l on l.start_dt = a.start_dt
  left join taken{i} t on t.publication = a.publication where a.turn = {i} group by all),
sp{i} as (select distinct on (g.publication, l.slot, l.band, l.offset_days) g.publication, l.*, case when gap is null or gap >= 1440 then 24 when gap >= 720 then 12 when gap >= 360 then 6 end as spacing_hours
  from gap{i} g join legal l on l.start_dt = g.start_dt and l.slot = g.slot),
top{i} as (select * from (select *, row_number() over (partition by publication order by widening, spacing_hours desc, band, abs(offset_days - 6), day, off_mid, slot) as rn from sp{i} where spacing_hours is not null) where rn = 1),
pick{i} as (select a.publication, a.article_id, coalesce(slot, case when latest >= {NOW} + interval 2 hour then latest else {NOW} + interval 2 hour end) as publish_at, band, spacing_hours, slot is null as lead_window_missed
  from turns a left join top{i} t on t.publication = a.publication left join lr on lr.start_dt = a.start_dt where a.turn = {i})""")
    return ", ".join(out)


_LAST = """lim as (select start_dt, start_dt - interval 24 hour as lim from starts),
ld as (select start_dt, lim, unnest([cast(lim as date), cast(lim as date) - 1]) as day from lim),
lg as (select start_dt, lim, cast(day as timestamp) + to_minutes(cast(unnest(range(first, last + 1, 15)) as int)) as slot, day from ld join """ + _BANDS + """ on list_contains(days, isodow(day))),
lr as (select start_dt, max(slot) as latest from lg where slot <= lim and not (isodow(day) = 5 and slot >= cast(day as timestamp) + interval 15 hour) group by start_dt)"""


@register("w6_assign_slots", f"""
with {_SLOTS}, {_LAST}, turns as (select * from (select publication, article_id, start_dt, row_number() over (partition by publication order by relevance_avg desc nulls last, start_dt asc nulls first, article_id) as turn
  from articles join {_DATED} using (event_id) where status in ('queued', 'in_progress')) where turn <= 5), {_turns(5)}
select publication, article_id, null::varchar as publish_at, null::int as band, null::int as spacing_hours, null::boolean as lead_window_missed
  from articles where status in ('queued', 'in_progress') and article_id not in (select article_id from turns) union all
""" + " union all ".join(f"select publication, article_id, cast(publish_at as varchar) as publish_at, band, spacing_hours, lead_window_missed from pick{i}" for i in range(1, 6)), AE)
def w6_assign_slots(t):
    open_ = work.work_queue(t.articles, t.article_events).withColumn("start_dt", F.expr("if(event_id % 50 <> 49, start_dt, null)"))
    return slots.assign_slots(open_, queue(t), AS_OF, K.ARTICLES_PER_RUN)
