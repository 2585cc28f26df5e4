"""Inputs of the registered queries: projections of the given tables, one SQL text per view.

The same text runs in Spark and in DuckDB; ``{TS}`` and ``{SHA}`` name the dialects' timestamp
type and hash, and a pair holds the two dialects where one text cannot serve both. Remainders
in a view model state left by an earlier run (what was seen, what was scored); every query
still reads its whole input tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-08 08:00:00"
BASE = ("region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations").split()

_REAL = "cast(floor(event_id / 4) as bigint)"

VIEWS: dict[str, str | tuple[str, str]] = {
    "listings": """
select event_id as pos, cast(floor(event_id / 4) as bigint) as real_id,
  case event_id % 7 when 0 then 'eventbrite' when 1 then 'venue_site' when 2 then 'visitseattle'
    when 3 then 'seattlegov' when 4 then 'do206' when 5 then 'thestranger' else 'reddit' end as source,
  cast(case when event_id % 50 = 49 then event_id - 7 else event_id end as string) as source_id,
  'https://Host' || cast(event_id % 7 as string) || '.example/e/'
    || cast(cast(floor(event_id / 4) as bigint) as string) || case when event_id % 2 = 0 then '/' else '?utm=x' end as url,
  case cast(floor(event_id / 4) as bigint) % 8 when 0 then 'Green Lake 5K' when 1 then 'Ballard  Yoga Flow'
    when 2 then 'Fremont Cycling Ride' when 3 then 'Casino Night' when 4 then 'Capitol Hill Market'
    when 5 then 'Startup Webinar' when 6 then 'Georgetown Bootcamp' else 'Jazz Concert' end
    || ' No ' || cast(cast(floor(event_id / 4) as bigint) as string) as title,
  case when event_id % 9 = 0 then ' ' else event_type || ' with  k ' || props end as description,
  case when event_id % 13 = 0 then null else cast('2024-01-01 09:00:00' as {TS})
    + interval '1' day * cast(cast(floor(event_id / 4) as bigint) % 30 as int)
    + interval '1' hour * cast(4 * (cast(floor(event_id / 2400) as bigint) % 4) as int)
    + interval '1' minute * cast((event_id % 4) * 20 as int) end as start_dt,
  cast(null as {TS}) as end_dt,
  case when event_id % 2 = 0 then 'The Venue ' else 'venue ' end
    || cast(cast(floor(event_id / 4) as bigint) % 50 as string) as venue_name,
  cast(100 + cast(floor(event_id / 4) as bigint) % 50 as string) || ' Pine St, Seattle, WA' as venue_address,
  case when event_id % 11 = 0 then null when event_id % 17 = 0 then '$99'
    else '$' || cast(10 + 5 * (cast(floor(event_id / 4) as bigint) % 5) as string) end as price,
  case when event_id % 3 = 0 then 'https://reg.example/r/'
    || cast(cast(floor(event_id / 4) as bigint) as string) else null end as register_url,
  cast(null as string) as image_url
from events""",
    "sessions": """
select pos, source, source_id, url, title, description, end_dt, price, image_url,
  case when start_dt is null then null when pos % 10 = 3 then cast('2024-01-01 00:00:00' as {TS})
      + interval '1' day * cast(cast(floor(real_id / 6) as bigint) % 30 as int)
    else cast('2024-01-01 09:00:00' as {TS}) + interval '1' day * cast(cast(floor(real_id / 6) as bigint) % 30 as int)
      + interval '1' minute * cast(110 * (real_id % 6) + (pos % 4) * 5 as int) end as start_dt,
  'Hall ' || cast(cast(floor(real_id / 6) as bigint) % 40 as string) as venue_name,
  case when pos % 5 = 0 then null else cast(100 + cast(floor(real_id / 12) as bigint) % 40 as string) || ' Pine St, Seattle' end as venue_address,
  case when pos % 4 = 1 then 'https://reg.example/f/' || cast(cast(floor(real_id / 6) as bigint) as string)
    when pos % 4 = 2 then register_url else null end as register_url
from listings""",
    "fingerprints": """
select source || ':' || source_id as fingerprint, cast(null as string) as canonical_id,
  case when pos % 5 = 0 then '0000000000000000' else substr({SHA}(coalesce(cast(start_dt as string), '')
    || '|' || venue_name || '|' || coalesce(price, '')), 1, 16) end as content_hash,
  cast('2024-01-01 00:00:00' as {TS}) as first_seen, cast('2024-01-05 00:00:00' as {TS}) as last_seen
from listings where pos % 3 <> 0 and pos % 50 <> 49""",
    "scores": """
select source || ':' || source_id as fingerprint, cast(1 + (pos * 7) % 10 as int) as category_fit,
  cast(1 + (pos * 3) % 10 as int) as audience_fit, cast(5 + pos % 6 as int) as timeliness,
  pos % 19 <> 0 as pass_flag
from listings where pos % 50 <> 49 and pos % 23 <> 7""",
    "gtfs_routes": """
select 'metro' as feed, cast(p_partkey as string) as route_id, cast(p_partkey as string) as route_short_name,
  p_name || case when p_partkey % 5 = 0 then ' Streetcar' else '' end as route_long_name,
  cast(p_size % 13 as string) as route_type
from part""",
    "gtfs_trips": """
select 'metro' as feed, cast(o_orderkey as string) as trip_id, cast(o_orderkey % 200 as string) as route_id
from orders""",
    "gtfs_stop_times": """
select 'metro' as feed, cast(l_orderkey as string) as trip_id, cast(l_suppkey as string) as stop_id
from lineitem""",
    "gtfs_stops": """
select 'metro' as feed, cast(s_suppkey as string) as stop_id, 'Stop ' || cast(s_suppkey % 40 as string) as stop_name,
  47.55 + (s_suppkey % 10) * 0.004e0 as stop_lat, -122.35 + (s_suppkey % 7) * 0.004e0 as stop_lon
from supplier""",
    "points": """
select c_custkey as point_id, 47.50 + (c_custkey % 17) * 0.01e0 as lat, -122.40 + (c_custkey % 13) * 0.01e0 as lon
from customer""",
    "observations": """
select real_id as event_id, source, pos % 23 <> 0 as fetch_ok,
  case when pos % 29 = 0 then start_dt + interval '1' hour when real_id % 3 <> 0 then cast(cast(start_dt as date) as {TS}) else start_dt end as stated_start,
  venue_name as stated_venue, venue_address as stated_address,
  case when pos % 31 = 0 then 'donation' else price end as stated_price,
  case when pos % 37 = 0 then 'cancelled' when pos % 41 = 0 then 'sold_out' else null end as status_flag
from listings""",
    "articles": """
select 'art_' || cast(o_orderkey as string) as article_id, o_orderkey % 300 as event_id,
  case o_orderkey % 6 when 0 then 's3_validate' when 1 then 's4_write' when 2 then 's5_factcheck'
    when 3 then 's6_judges' when 4 then 's7_eic' else 's9_publish' end as stage,
  case o_orderkey % 5 when 0 then 'queued' when 1 then 'in_progress' when 2 then 'held'
    when 3 then 'scheduled' else 'published' end as status,
  cast(o_orderkey % 4 as int) as reholds,
  case when o_orderkey % 10 = 0 then null else cast(o_custkey % 30 as double) / 10 + 7 end as relevance_avg,
  case when o_orderkey % 5 = 2 then 's6_judges' else null end as hold_stage,
  cast('2024-01-08 07:45:00' as {TS}) + interval '1' hour * cast((o_orderkey % 40) * 9 as int) as publish_at,
  cast('2024-01-07 00:00:00' as {TS}) + interval '1' minute * cast(o_custkey % 1440 as int) as updated_at,
  cast(o_orderkey % 3 as int) as attempt_count,
  o_orderpriority as publication
from orders""",
    "article_events": """
select distinct event_id, cast('2024-01-09 10:00:00' as {TS}) + interval '1' hour * cast(event_id * 5 as int) as start_dt,
  'The Venue ' || cast(event_id % 50 as string) as venue_name,
  case when event_id % 4 = 0 then 'Ballard' when event_id % 4 = 1 then 'Green Lake' else 'Belltown' end as neighborhood
from articles""",
    "published": """
select 'post_' || article_id as post_id, article_id, event_id, 'slug-' || article_id as slug,
  publish_at + interval '6' day as event_start_dt,
  case when event_id % 9 = 0 then 'ended' else 'live' end as state
from articles where status = 'published'""",
    "drafts": """
select doc_id as draft_id, substr(text, 1, 80) as hook_line,
  text || case doc_id % 10 when 0 then ' leverage a vibrant journey' when 3 then ' you should try this'
    when 7 then ' prevents injury and builds endurance' else '' end
    || case when doc_id % 12 = 0 then ' —' else '' end as body,
  case when doc_id % 3 = 0 then 'Doc' else regexp_extract(text, '^[^ ]+ [^ ]+', 0) end || ' ' || cast(doc_id as string) || case when doc_id % 7 = 0 then ' | Mag' else '' end as meta_title,
  case when doc_id % 4 = 0 then substr(text, 1, 160) else 'August 22 in Ballard, item ' || cast(doc_id as string) end as meta_description,
  case when doc_id % 6 = 0 then 'Bad Slug' else 'doc-item-' || cast(doc_id as string) end as slug_stem
from documents""",
    "draft_events": """
select doc_id as event_id, cast('2026-08-22 09:00:00' as {TS}) as start_dt,
  case when doc_id % 5 = 0 then 'Fremont' else 'Ballard' end as neighborhood,
  regexp_extract(text, '^[^ ]+ [^ ]+', 0) as title, 'Venue ' || cast(doc_id % 40 as string) as venue_name,
  case when doc_id % 3 = 0 then cast(doc_id as string) || ' Pike St, Seattle' end as venue_address,
  case when doc_id % 2 = 0 then '$' || cast(doc_id % 90 as string) end as price,
  case when doc_id % 4 = 1 then 'https://reg.example/' || cast(doc_id as string) else ' ' end as register_url
from documents""",
    "verdicts": (
        """
select draft_id, element_at(array('voice_brand_compliance', 'structural_format_compliance', 'editorial_value',
    'factual_venue_integrity', 'seattle_local_specificity', 'ai_pattern_detection', 'seo'), n + 1) as dimension,
  cast(least(10, 7 + (draft_id * 3 + n * 5) % 4 + case when draft_id % 3 = 0 then 1 else 0 end) as int) as score,
  case when draft_id % 8 = 0 then 'not in the draft' else substr(body, 3, 12) end as excerpt
from drafts lateral view explode(sequence(0, 6)) s as n
where not (draft_id % 15 = 0 and n = 6)""",
        """
select draft_id, (['voice_brand_compliance', 'structural_format_compliance', 'editorial_value',
    'factual_venue_integrity', 'seattle_local_specificity', 'ai_pattern_detection', 'seo'])[n + 1] as dimension,
  cast(least(10, 7 + (draft_id * 3 + n * 5) % 4 + case when draft_id % 3 = 0 then 1 else 0 end) as int) as score,
  case when draft_id % 8 = 0 then 'not in the draft' else substr(body, 3, 12) end as excerpt
from (select *, unnest(range(7)) as n from drafts) t
where not (draft_id % 15 = 0 and n = 6)"""),
    "responses": """
select conv_id * 100 + turn as response_id,
  case turn % 4 when 0 then 'bare' when 1 then 'fenced' when 2 then 'prose' else 'bad' end as kind,
  case turn % 4 when 0 then '{"score": ' || cast(conv_id % 10 as string) || '}'
    when 1 then '```json' || chr(10) || '{"score": ' || cast(conv_id % 10 as string) || '}' || chr(10) || '```'
    when 2 then 'Sure. {"score": ' || cast(conv_id % 10 as string) || '} Done.' else 'no json' end as payload
from conversations""",
    "pages_jsonld": """
select page_id, url, html || case when page_id % 3 = 0 then '<script type="application/ld+json">{"@graph":[{"@type":"SportsEvent","name":"Run '
  || cast(page_id as string) || '","offers":{"lowPrice":"10","highPrice":"25"}},{"@type":"EventVenue","name":"x"}]}</script>'
  when page_id % 3 = 1 then '<script type="application/ld+json">{broken</script>' else '' end as html
from pages""",
}


def needed(*names: str) -> list[str]:
    """The named views and the views they read, in definition order."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name in VIEWS and name not in wanted:
            wanted.add(name)
            text = VIEWS[name] if isinstance(VIEWS[name], str) else VIEWS[name][0]
            for used in re.findall(r"\bfrom (\w+)|\(select \*, [^)]*\) as n from (\w+)", text):
                for u in used:
                    add(u)

    for n in names:
        add(n)
    return [v for v in VIEWS if v in wanted]


def spark_text(name: str) -> str:
    text = VIEWS[name] if isinstance(VIEWS[name], str) else VIEWS[name][0]
    return re.sub(r"\{SHA\}\(", "listflow_sha(", text).replace("{TS}", "timestamp_ntz")


def duck_text(name: str) -> str:
    text = VIEWS[name] if isinstance(VIEWS[name], str) else VIEWS[name][1]
    return text.replace("{SHA}", "sha256").replace("{TS}", "timestamp")


class Tables:
    """The given tables and the projected views of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}
        spark.sql("create or replace temporary function listflow_sha(x string) "
                  "returns string return sha2(x, 256)")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
            self._made[name].createOrReplaceTempView(name)
        return self._made[name]

    def _make(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in VIEWS:
            raise AttributeError(name)
        text = VIEWS[name] if isinstance(VIEWS[name], str) else VIEWS[name][0]
        for word in set(re.findall(r"\bfrom (\w+)", text)):
            if word in BASE or word in VIEWS:
                getattr(self, word).createOrReplaceTempView(word)
        return self.spark.sql(spark_text(name))


def oracle(body: str, *views: str) -> str:
    """A DuckDB query: the needed views as CTEs, then the body (which may add its own CTEs)."""
    ctes = [f"{v} as ({duck_text(v)})" for v in needed(*views)]
    body = body.strip()
    recursive = bool(re.match(r"(?i)with\s+recursive\b", body))
    own = re.match(r"(?i)with(\s+recursive)?\s+", body)
    if own:
        body = body[own.end():]
        head = ", ".join(ctes) + (", " if ctes else "")
        return f"with {'recursive ' if recursive else ''}{head}{body}"
    return f"with {', '.join(ctes)} {body}" if ctes else body
