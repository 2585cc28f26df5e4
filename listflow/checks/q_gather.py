"""Checked queries: landing, normalizing, filtering and change detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from listflow import constants as K
from listflow.checks.fixtures import AS_OF
from listflow.checks.registry import register
from listflow.checks.sqlparts import (
    CONTENT_HASH, EXCLUDED, GROUPS, INCLUDED, NOW, PRIORITY, clean, collapse, q, values)
from listflow.functions import dates, keys, text
from listflow.operators import changes, filters
from listflow.session import dimension, scratch_path
from listflow.sources import listings as src

L = ("listings",)
FP = ("listings", "fingerprints")
_NAMES = "pos, source, source_id, url, title, description, cast(start_dt as varchar) as start_dt, " \
         "venue_name, venue_address, price, register_url, image_url"


@register("s1_read_listings", """
select event_type as source, cast(null as varchar) as source_id, cast(null as varchar) as url,
  cast(null as varchar) as title, props as description, cast(null as varchar) as price, event_id,
  case when event_id % 11 <> 0 then strftime(timestamp '2024-01-08 09:00:00' + interval 1 minute * cast(event_id % 40000 as int), '%Y-%m-%d %H:%M:%S') end as start_dt
from events""")
def s1_read_listings(t):
    """Landed rows, written and read; one winter's wall-clock times stated in four ways."""
    at = "timestamp_ntz'2024-01-08 09:00:00' + make_dt_interval(0, 0, cast(event_id % 40000 as int)"
    text = lambda minutes: f"date_format({at} + {minutes}), \"yyyy-MM-dd'T'HH:mm:ss\")"
    stated = (f"case when event_id % 11 = 0 then null when event_id % 4 = 0 then concat({text(480)}, 'Z') "
              f"when event_id % 4 = 1 then concat({text(0)}, '-08:00') "
              f"when event_id % 4 = 2 then concat({text(180)}, '-05:00') else {text(0)} end")
    landed = scratch_path(t.spark, "landed")
    t.events.select("event_id", F.col("event_type").alias("source"), F.col("props").alias("description"),
                    F.expr(stated).alias("start_dt")).write.parquet(landed)
    return src.read_listings(t.spark, landed).select(
        "source", "source_id", "url", "title", "description", "price", "event_id",
        F.date_format("start_dt", "yyyy-MM-dd HH:mm:ss").alias("start_dt"))


@register("s9_source_coverage", f"""
with expected as (select * from {values([(s,) for s in K.SOURCE_ORDER + ('meetup',)], ['source'], 'v')}),
counts as (select source, count(*) as n from listings group by source),
per as (select e.source, coalesce(n, 0) as n_listings from expected e left join counts using (source))
select source, n_listings, n_listings = 0 as silent, (select sum(n_listings) from per) = 0 as all_silent from per
""", L)
def s9_source_coverage(t):
    expected = dimension(
        t.spark, [(s, True) for s in K.SOURCE_ORDER + ("meetup",)] + [("paused", False)], ["source", "enabled"])
    return src.source_coverage(t.listings, expected)


@register("s10_write_snapshot", "select fingerprint, content_hash, cast(last_seen as varchar) as last_seen from fingerprints", FP)
def s10_write_snapshot(t):
    path = src.write_snapshot(t.fingerprints, scratch_path(t.spark, "snapshot"), "run1")
    return t.spark.read.parquet(path).select("fingerprint", "content_hash", "last_seen")


@register("p1_normalize_listing", f"""
select pos, source, coalesce({clean('source_id')}, trim(url)) as source_id, trim(url) as url,
  coalesce({clean('title')}, '') as title, coalesce({clean('description')}, '') as description,
  {clean('venue_name')} as venue_name, {clean('venue_address')} as venue_address, {clean('price')} as price,
  {clean('register_url')} as register_url, {clean('image_url')} as image_url from listings""", L)
def p1_normalize_listing(t):
    return filters.normalize_listing(t.listings).select(
        "pos", "source", "source_id", "url", "title", "description", "venue_name", "venue_address",
        "price", "register_url", "image_url")


@register("p2_valid_listing", "select pos, url, description as title from listings where url <> '' and trim(description) <> ''", L)
def p2_valid_listing(t):
    blanked = filters.normalize_listing(t.listings.withColumn("title", F.col("description")))
    kept = filters.valid_listing(blanked).select("pos", "url")
    return kept.join(t.listings.select("pos", F.col("description").alias("title")), "pos")


@register("p3_collect_window", f"""
select pos, cast(start_dt as varchar) as start_dt from listings
where start_dt is null or (start_dt >= date_trunc('day', {NOW}) and start_dt < date_trunc('day', {NOW}) + interval 11 day)""", L)
def p3_collect_window(t):
    return filters.collect_window(t.listings, AS_OF, 10).select("pos", "start_dt")


@register("p4_lead_window", f"""
select pos, cast(start_dt as varchar) as start_dt from listings
where start_dt >= {NOW} + interval 7 day and start_dt <= {NOW} + interval 10 day""", L)
def p4_lead_window(t):
    return filters.lead_window(t.listings, AS_OF, 7, 10).select("pos", "start_dt")


_GROUP_LIST = "array_to_string(list_filter([" + ", ".join(
    f"case when {c} then {q(g)} end" for g, c in GROUPS.items()) + "], lambda x: x is not null), ',')"


@register("p5_keyword_filter", f"""
select pos, title, {_GROUP_LIST} as keyword_groups from listings where not {EXCLUDED} and {INCLUDED}""", L)
def p5_keyword_filter(t):
    return filters.keyword_filter(t.listings).select(
        "pos", "title", F.array_join("keyword_groups", ",").alias("keyword_groups"))


def _word_any(terms):
    import re
    return "(" + " or ".join(
        rf"regexp_matches(hay, '(^|[^\p{{L}}\p{{N}}]){re.escape(x).replace(chr(92) + ' ', chr(92) + 's+')}([^\p{{L}}\p{{N}}]|$)')"
        for x in terms) + ")"


@register("p5_keyword_filter_words", f"""
with h as (select pos as doc_id, lower(title || ' ' || description) as hay from listings)
select doc_id, array_to_string(list_filter([{', '.join(f"case when {_word_any(x)} then {q(g)} end" for g, x in K.KEYWORDS.items())}], lambda x: x is not null), ',') as keyword_groups
from h where not {_word_any(K.KEYWORD_EXCLUDES)} and ({' or '.join(_word_any(x) for x in K.KEYWORDS.values())})""", L)
def p5_keyword_filter_words(t):
    docs = t.listings.select(F.col("pos").alias("doc_id"), "title", "description")
    return filters.keyword_filter(docs, mode="word").select(
        "doc_id", F.array_join("keyword_groups", ",").alias("keyword_groups"))


_AVG = "round((category_fit + audience_fit + timeliness) / 3.0::double, 2)"


@register("p6_relevance_gate", f"select fingerprint, {_AVG} as relevance_avg from scores where {_AVG} >= 7.0 and pass_flag", ("scores",))
def p6_relevance_gate(t):
    return filters.relevance_gate(t.scores).select("fingerprint", "relevance_avg")


@register("p7_timeliness_band", f"""
with d as (select pos, datediff('day', date '2024-01-08', cast(start_dt as date)) as days_out, start_dt < {NOW} as past from listings),
b as (select *, case when days_out is null or past or days_out <= 1 or days_out > 45 then 1
  when days_out between 7 and 10 then 9 when days_out in (5, 6) or days_out between 11 and 14 then 7 else 4 end as band_low from d)
select pos, cast(days_out as int) as days_out, band_low, case band_low when 9 then 10 when 7 then 8 when 4 then 6 else 3 end as band_high from b""", L)
def p7_timeliness_band(t):
    return filters.timeliness_band(t.listings, AS_OF).select("pos", "days_out", "band_low", "band_high")


@register("p8_drop_too_late", f"""
select pos, cast(start_dt as varchar) as start_dt from listings where start_dt is null or start_dt >= {NOW} + interval 2 day""", L)
def p8_drop_too_late(t):
    return filters.drop_too_late(t.listings, AS_OF).select("pos", "start_dt")


@register("p9_in_bounds", """
with c as (select c_custkey, 47.3 + (c_custkey % 1000) / 1403.7e0 as lat, -122.6 + (c_custkey % 777) / 1231.1e0 as lon from customer)
select c_custkey, round(lat, 6) as lat, round(lon, 6) as lon from c
where lat between 47.40 and 47.80 and lon between -122.55 and -122.10""")
def p9_in_bounds(t):
    c = t.customer.selectExpr("c_custkey", "47.3 + (c_custkey % 1000) / 1403.7e0 as lat",
                              "-122.6 + (c_custkey % 777) / 1231.1e0 as lon")
    return filters.in_bounds(c)


@register("p11_explicit_value_filter", """
select pos, coalesce(case when trim(description) <> '' then description end, case when trim(price) <> '' then price end, title) as value from listings""", L)
def p11_explicit_value_filter(t):
    return t.listings.select("pos", text.first_value(
        F.col("description"), F.col("price"), F.col("title")).alias("value"))


@register("p12_payload_view", "select pos, title, venue_name, price, source as first_source from listings", L)
def p12_payload_view(t):
    events = t.listings.select("pos", "title", "venue_name", "price", F.array("source").alias("sources"),
                               F.to_json(F.struct("source")).alias("sources_json"))
    return filters.payload_view(events).select("event.*", F.col("sources")[0].alias("first_source"))


@register("u1_union_sources", """
select 'a' as batch, source, count(*) as n, count(price) as n_price from listings group by source
union all select 'b', event_type, count(*), 0 from events group by event_type""", L)
def u1_union_sources(t):
    a = t.listings.select(F.lit("a").alias("batch"), "source", "price")
    b = t.events.select(F.lit("b").alias("batch"), F.col("event_type").alias("source"))
    return src.union_sources(a, b).groupBy("batch", "source").agg(
        F.count("*").alias("n"), F.count("price").alias("n_price"))


@register("w1_dedupe_same_source", """
select pos, source, source_id from (select *, row_number() over (partition by source, coalesce(nullif(source_id, ''), url) order by pos) as rn from listings) where rn = 1""", L)
def w1_dedupe_same_source(t):
    return filters.dedupe_same_source(t.listings).select("pos", "source", "source_id")


@register("f1_clean_text", f"select doc_id, sha256({clean('text')}) as h, length({clean('text')}) as n from documents")
def f1_clean_text(t):
    cleaned = text.clean_text(F.col("text"))
    return t.documents.select("doc_id", F.sha2(cleaned, 256).alias("h"),
                              F.length(cleaned).cast("bigint").alias("n"))


_BLOCKS = r"(?i)</\s*(?:p|div|li|tr|h[1-6])\s*>|<\s*br\s*/?\s*>"
_PLAIN = (f"regexp_replace(replace(replace(replace(regexp_replace(regexp_replace(html, '{_BLOCKS}', ' ', 'g'), '<[^>]+>', ' ', 'g'),"
          " '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;?', '&', 'g')")


@register("f2_strip_html", f"select page_id, {clean(_PLAIN)} as plain from pages")
def f2_strip_html(t):
    return t.pages.select("page_id", text.strip_html(F.col("html")).alias("plain"))


@register("f8_content_hash", f"select pos, {CONTENT_HASH} as content_hash from listings", L)
def f8_content_hash(t):
    return t.listings.select("pos", keys.content_hash(
        F.col("start_dt"), F.col("venue_name"), F.col("price")).alias("content_hash"))


@register("f9_fingerprint", "select pos, source || ':' || source_id as fingerprint from listings", L)
def f9_fingerprint(t):
    return t.listings.select("pos", keys.fingerprint(F.col("source"), F.col("source_id")).alias("fingerprint"))


@register("f10_canonical_id", """
select pos, 'evt_' || substr(sha256(trim(lower(title)) || '|' || coalesce(substr(cast(start_dt as varchar), 1, 16), '') || '|' || trim(lower(venue_name))), 1, 16) as event_id from listings""", L)
def f10_canonical_id(t):
    return t.listings.select("pos", keys.canonical_id(
        F.col("title"), F.col("start_dt"), F.col("venue_name")).alias("event_id"))


@register("f11_slugify", """
select pos, substr(regexp_replace(regexp_replace(lower(title || ' & ' || description || ' ' || url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60)
  || case when start_dt is null then '' else '-' || strftime(start_dt, '%Y-%m-%d') end as slug from listings""", L)
def f11_slugify(t):
    stem = F.concat_ws("", "title", F.lit(" & "), "description", F.lit(" "), "url")
    return t.listings.select("pos", text.slugify(stem, F.col("start_dt")).alias("slug"))


@register("f19_details_when", r"""
select pos, case when start_dt is not null then strftime(start_dt, '%A, %B %-d, %-I:%M %p') end as shown from listings""", L)
def f19_details_when(t):
    return t.listings.select("pos", dates.details_when(F.col("start_dt")).alias("shown"))


@register("f26_word_count", f"""
select doc_id, len(list_filter(string_split({collapse('text')}, ' '), lambda x: x <> '')) as n_words,
  len(list_filter(string_split(text, chr(10) || chr(10)), lambda x: {collapse('x')} <> '')) as n_paragraphs from documents""")
def f26_word_count(t):
    return t.documents.select(
        "doc_id", text.word_count(F.col("text")).cast("bigint").alias("n_words"),
        F.size(text.paragraphs(F.col("text"))).cast("bigint").alias("n_paragraphs"))


_DEDUPED = """d as (select * from (select *, row_number() over (partition by source, source_id order by pos) as rn from listings) where rn = 1)"""
_CLASS = f"""c as (select d.*, {CONTENT_HASH.replace('start_dt', 'd.start_dt')} as new_hash, f.content_hash as known,
  case when f.fingerprint is null then 'new' when f.content_hash <> {CONTENT_HASH} then 'changed' else 'unchanged' end as change
  from d left join fingerprints f on f.fingerprint = d.source || ':' || d.source_id)"""


@register("j1_change_filter", f"with {_DEDUPED}, {_CLASS} select pos, change, new_hash as content_hash from c where change <> 'unchanged'", FP)
def j1_change_filter(t):
    fresh = filters.dedupe_same_source(t.listings)
    return changes.change_filter(fresh, t.fingerprints).select("pos", "change", "content_hash")


@register("j1_refresh_seen", f"""
with {_DEDUPED}, {_CLASS} select f.fingerprint, cast(case when c.change = 'unchanged' then {NOW} else f.last_seen end as varchar) as last_seen
from fingerprints f left join c on f.fingerprint = c.source || ':' || c.source_id""", FP)
def j1_refresh_seen(t):
    marked = changes.classify_changes(filters.dedupe_same_source(t.listings), t.fingerprints)
    return changes.refresh_seen(t.fingerprints, marked, AS_OF).select("fingerprint", "last_seen")


@register("m1_merge_fingerprints", f"""
with {_DEDUPED}, u as (select source || ':' || source_id as fingerprint, {CONTENT_HASH} as h,
  case when pos % 2 = 0 then 'evt_' || pos end as cid from d)
select fingerprint, coalesce(u.cid, f.canonical_id) as canonical_id, coalesce(u.h, f.content_hash) as content_hash,
  cast(coalesce(f.first_seen, {NOW}) as varchar) as first_seen, cast(case when u.fingerprint is not null then {NOW} else f.last_seen end as varchar) as last_seen
from fingerprints f full join u using (fingerprint)""", FP)
def m1_merge_fingerprints(t):
    u = changes.with_keys(filters.dedupe_same_source(t.listings)).selectExpr(
        "fingerprint", "content_hash", "case when pos % 2 = 0 then concat('evt_', pos) end as canonical_id")
    return changes.merge_fingerprints(t.fingerprints, u, AS_OF)


_REASONS = f"""r as (select c.*, s.category_fit, s.audience_fit, s.timeliness, s.pass_flag,
  case when start_dt is null or start_dt < {NOW} or start_dt > {NOW} + interval 10 day then 'window'
    when {EXCLUDED} or not {INCLUDED} then 'keyword' when change = 'unchanged' then 'seen'
    when s.fingerprint is null then 'unscored' when not coalesce({_AVG} >= 7.0 and pass_flag, false) then 'score' end as reject_reason, {_AVG} as relevance_avg
  from c left join scores s on s.fingerprint = c.source || ':' || c.source_id)"""
_ALL = ("listings", "fingerprints", "scores")


@register("a7_gather_report", f"""
with {_DEDUPED}, {_CLASS}, {_REASONS}
select count(*) as raw, count(*) filter (reject_reason is null) as qualified, count(*) filter (reject_reason = 'window') as skipped_window,
  count(*) filter (reject_reason = 'keyword') as skipped_keyword, count(*) filter (reject_reason = 'seen') as skipped_seen,
  count(*) filter (reject_reason = 'unscored') as skipped_unscored, count(*) filter (reject_reason = 'score') as skipped_score from r""", _ALL)
def a7_gather_report(t):
    fresh = filters.dedupe_same_source(t.listings)
    return changes.gather_report(changes.gather_reasons(fresh, t.fingerprints, t.scores, AS_OF))


def qualified(t):
    fresh = filters.dedupe_same_source(t.listings)
    reasons = changes.gather_reasons(fresh, t.fingerprints, t.scores, AS_OF)
    return changes.to_candidates(reasons.filter("reject_reason is null"))


@register("t2_ordered_candidates", f"""
with {_DEDUPED}, {_CLASS}, {_REASONS}
select source || ':' || source_id as candidate_id, cast({PRIORITY} as int) as priority, relevance_avg, change from r where reject_reason is null
order by priority, relevance_avg desc nulls last, candidate_id""", _ALL)
def t2_ordered_candidates(t):
    return changes.ordered_candidates(qualified(t)).select(
        "candidate_id", "priority", "relevance_avg", "change")


@register("m2_replace_candidates", f"""
with {_DEDUPED}, {_CLASS}, {_REASONS}, u as (select source || ':' || source_id as candidate_id, relevance_avg from r where reject_reason is null)
select candidate_id, coalesce(u.relevance_avg, o.relevance_avg) as relevance_avg
from (select fingerprint as candidate_id, 0.0::double as relevance_avg from scores) o full join u using (candidate_id)""", _ALL)
def m2_replace_candidates(t):
    current = t.scores.select(F.col("fingerprint").alias("candidate_id"), F.lit(0.0).alias("relevance_avg"))
    return changes.replace_candidates(current, qualified(t).select("candidate_id", "relevance_avg"))


@register("m2_clear_candidates", f"""
with {_DEDUPED}, {_CLASS}, {_REASONS} select fingerprint as candidate_id from scores
where fingerprint not in (select source || ':' || source_id from r where reject_reason is null)""", _ALL)
def m2_clear_candidates(t):
    current = t.scores.select(F.col("fingerprint").alias("candidate_id"))
    return changes.clear_candidates(current, qualified(t))
