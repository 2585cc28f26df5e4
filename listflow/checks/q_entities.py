"""Checked queries: matching, merging, enrichment and verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from listflow import constants as K
from listflow.checks.fixtures import AS_OF
from listflow.checks.q_transit import G, HAVERSINE, MODE, ROUTES, STOPS, stops
from listflow.checks.registry import register
from listflow.checks.sqlparts import (
    CONTENT_HASH, PRIORITY, name_key, q, street_key, values, venue_key)
from listflow.functions import keys, price, text, urls
from listflow.operators import enrichment, matching, merging, transit, verification

L = ("listings",)


def url_key(c):
    bare = rf"regexp_replace(regexp_replace(regexp_replace(trim({c}), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*$', ''), '/$', '')"
    host = rf"regexp_extract({bare}, '^[^/]*')"
    return f"nullif(lower({host}) || substr({bare}, length({host}) + 1), '')"


_DAYS = "(?:" + "|".join(f"{d}|{d[:3]}" for d in K.WEEKDAYS) + ")"
_MONTHS = "(?:" + "|".join(f"{m}|{m[:3]}" for m in K.MONTHS) + ")"


def title_tokens(c):
    t = rf"trim(regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    t = rf"regexp_replace({t}, '^(?:{_DAYS} )?(?:(?:{_MONTHS} \d{{1,2}}(?:st|nd|rd|th)?(?: \d{{4}})?|\d{{1,2}} \d{{1,2}} \d{{2,4}}|\d{{4}} \d{{1,2}} \d{{1,2}}) )?', '')"
    t = rf"regexp_replace({t}, '(.) ?presented by .*$', '\1')"
    t = rf"trim(regexp_replace({t}, '\b(?:tickets|registration)\b', ' ', 'g'))"
    t = rf"regexp_replace({t}, ' (?:19|20)\d{{2}}$', '')"
    skip = "[" + ", ".join(q(w) for w in K.STOPWORDS + K.GENERIC_TITLE_WORDS + [""]) + "]"
    return (f"list_distinct(list_filter(string_split(trim(regexp_replace({t}, '\\s+', ' ', 'g')), ' '), "
            f"lambda w: not list_contains({skip}, w)))")


_WRAPPED = """case pos % 7 when 0 then 'Saturday, August 22: ' || title when 1 then title || ' presented by Rainy City Co'
  when 2 then title || ' Tickets 2026' when 3 then 'Registration - ' || title when 4 then '2026-08-22 ' || title
  when 5 then 'Fri ' || title || ' 2025' else title end"""


@register("f4_url_key", f"select pos, {url_key('url')} as url_key, {url_key('register_url')} as reg_key from listings", L)
def f4_url_key(t):
    return t.listings.select("pos", urls.url_key(F.col("url")).alias("url_key"),
                             urls.url_key(F.col("register_url")).alias("reg_key"))


@register("f5_registrable_domain", r"""
with h as (select page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) as host from pages)
select page_id, host, array_to_string(case when len(string_split(host, '.')) >= 2 then string_split(host, '.')[-2:] else string_split(host, '.') end, '.') as domain from h""")
def f5_registrable_domain(t):
    host = urls.host_of(F.col("url"))
    return t.pages.select("page_id", host.alias("host"), urls.registrable_domain(host).alias("domain"))


@register("f3_absolute_url", r"""
with a as (select page_id, url, unnest(list_distinct(list_append(regexp_extract_all(html, '<a href="([^"]*)"', 1), 'more/p' || page_id || '.html'))) as href from pages)
select page_id, href, case when href = '' or regexp_matches(href, '^(#|javascript:|mailto:|tel:)') then null
  when regexp_matches(href, '^https?://') then href when href like '/%' then regexp_extract(url, '^[a-z]+://[^/?#]*') || href
  else regexp_extract(url, '^[a-z]+://[^/?#]*') || coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/?#]*(/[^?#]*/|/)', 1), ''), '/') || href end as resolved from a""")
def f3_absolute_url(t):
    links = t.pages.select("page_id", "url", F.explode(F.array_distinct(F.array_append(F.regexp_extract_all(
        "html", F.lit(r'<a href="([^"]*)"'), 1), F.expr("concat('more/p', page_id, '.html')")))).alias("href"))
    return links.select(
        "page_id", "href", urls.absolute_url(F.col("url"), F.col("href")).alias("resolved"))


@register("f12_name_key", f"select pos, {name_key('title')} as name_key, {venue_key('venue_name')} as venue_key from (select pos, title, case when pos % 3 = 0 then venue_name || ' (North Lot)' else venue_name end as venue_name from listings)", L)
def f12_name_key(t):
    venue = F.expr("if(pos % 3 = 0, concat(venue_name, ' (North Lot)'), venue_name)")
    return t.listings.select("pos", text.name_key(F.col("title")).alias("name_key"),
                             text.venue_key(venue).alias("venue_key"))


@register("f13_street_key", f"select pos, {street_key('venue_address')} as street_key from listings", L)
def f13_street_key(t):
    return t.listings.select("pos", text.street_key(F.col("venue_address")).alias("street_key"))


@register("f14_title_tokens", f"with w as (select pos, {_WRAPPED} as wrapped from listings) select pos, array_to_string(list_sort({title_tokens('wrapped')}), ' ') as tokens from w", L)
def f14_title_tokens(t):
    wrapped = t.listings.select("pos", F.expr(_WRAPPED).alias("wrapped"))
    return wrapped.select("pos", F.array_join(F.array_sort(text.title_tokens(F.col("wrapped"))), " ").alias("tokens"))


_NODES = f"""n as (select pos as id, cast(start_dt as date) as day, start_dt as start, {venue_key('venue_name')} as venue, {street_key('venue_address')} as street,
  {name_key('title')} as title, {title_tokens('title')} as tokens, {url_key('url')} as url_key, {url_key('register_url')} as reg_key,
  strftime(start_dt, '%H:%M:%S') = '00:00:00' as untimed from listings)"""
_APART = "(a.venue = b.venue and a.title <> b.title and abs(date_diff('second', a.start, b.start)) > 10800 and not a.untimed and not b.untimed)"
_AUTO = f"""auto as (select a.id as src, b.id as dst from n a join n b on a.day = b.day and a.id < b.id and a.url_key = b.url_key where not coalesce({_APART}, false)
  union select a.id, b.id from n a join n b on a.day = b.day and a.id < b.id and a.reg_key = b.reg_key where not coalesce({_APART}, false))"""
_STD = f"""std as (select a.id as src, b.id as dst from n a join n b on a.day = b.day and a.id < b.id and (a.venue = b.venue or a.street = b.street)
  where (abs(date_diff('second', a.start, b.start)) <= 7200 or a.untimed or b.untimed) and list_has_any(a.tokens, b.tokens))"""


def _comp(edges, name):
    return f"""{name}_e as (select src, dst from {edges} union select dst, src from {edges}),
{name}_r as (select src as id, src as c from {name}_e union select e.dst, r.c from {name}_r r join {name}_e e on e.src = r.id),
{name} as (select id, min(c) as component from {name}_r group by id)"""


def _components(edges):
    """Components of an edge set as (id, component), for comparing edge sets by what they join."""
    return matching.connected_components(edges)


@register("j2_match_auto", f"with recursive {_NODES}, {_AUTO}, {_comp('auto', 'cc')} select id, component from cc", L)
def j2_match_auto(t):
    return _components(matching.match_auto(matching.match_keys(t.listings)))


@register("j3_match_standard", f"with recursive {_NODES}, {_STD}, {_comp('std', 'cc')} select id, component from cc", L)
def j3_match_standard(t):
    return _components(matching.match_standard(matching.match_keys(t.listings)))


@register("j4_never_merge", f"""
with {_NODES}, e as (select min(id) over (partition by street) as src, id as dst from n where street is not null)
select src, dst from e join n a on a.id = src join n b on b.id = dst where src <> dst and not coalesce(a.day <> b.day, false) and not coalesce({_APART}, false)""", L)
def j4_never_merge(t):
    nodes = matching.match_keys(t.listings)
    hub = nodes.groupBy("street").agg(F.min("id").alias("src"))
    edges = nodes.join(hub, "street").filter("id <> src").select("src", F.col("id").alias("dst"))
    return matching.never_merge(edges, nodes)


_RESOLVED = f"""{_NODES}, {_AUTO}, {_STD}, pairs as (select * from auto union select * from std), tm as (select * from n where day is not null and not untimed),
edges as (select * from pairs where src in (select id from tm) and dst in (select id from tm)), {_comp('edges', 'cc')},
tc as (select tm.*, coalesce(cc.component, tm.id) as component from tm left join cc on cc.id = tm.id),
bad as (select distinct a.component, a.venue from tc a join tc b on a.component = b.component and {_APART}),
tg as (select tc.id, min(tc.id) over (partition by tc.component, case when bad.venue is not null then tc.venue end, case when bad.venue is not null then coalesce(tc.title, '') end) as component
  from tc left join bad on bad.component = tc.component and bad.venue = tc.venue),
du as (select * from n where day is not null and untimed),
dn as (select src as id, dst as o from pairs union select dst, src from pairs), dm as (select dn.id, min(component) as lo, max(component) as hi from dn join tg on tg.id = dn.o where dn.id in (select id from du) group by dn.id),
df as (select * from du where id not in (select id from dm)), de as (select * from pairs where src in (select id from df) and dst in (select id from df)), {_comp('de', 'dc')},
dated as (select n.id, x.component, url_key, reg_key from n join (select id, component from tg union all select id, case when lo = hi then lo else id end from dm
  union all select df.id, coalesce(component, df.id) from df left join dc on dc.id = df.id) x on x.id = n.id),
nb as (select u.id, d.component from n u join dated d on u.url_key = d.url_key where u.day is null union select u.id, d.component from n u join dated d on u.reg_key = d.reg_key where u.day is null),
un as (select id, min(component) as lo, max(component) as hi from nb group by id),
fr as (select * from n where day is null and id not in (select id from un)),
fe as (select a.id as src, b.id as dst from fr a join fr b on a.id < b.id and (a.url_key = b.url_key or a.reg_key = b.reg_key)), {_comp('fe', 'fc')},
groups as (select id, component as group_id from dated union all select id, case when lo = hi then lo else id end from un
  union all select fr.id, coalesce(component, fr.id) from fr left join fc on fc.id = fr.id)"""
_SESSIONS = _RESOLVED.replace("as untimed from listings)", "as untimed from sessions)")


@register("j5_resolve_entities", f"with recursive {_RESOLVED} select id, group_id from groups", L)
def j5_resolve_entities(t):
    return matching.resolve_entities(t.listings)


@register("j5_resolve_sessions", f"with recursive {_SESSIONS} select id, group_id from groups", ("sessions",))
def j5_resolve_sessions(t):
    return matching.resolve_entities(t.sessions)


@register("j5_sessions_apart", f"""
with recursive {_SESSIONS}, g as (select n.*, group_id from n join groups using (id))
select 'groups' as what, count(distinct group_id) as n from g
union all select 'apart', count(*) from g a join g b on a.group_id = b.group_id and {_APART}""", ("sessions",))
def j5_sessions_apart(t):
    """Groups, and venues in them that hold sessions which must stay apart (none)."""
    groups = matching.resolve_entities(t.sessions).withColumnRenamed("group_id", "component")
    timed = matching.match_keys(t.sessions).filter("not untimed").join(groups, "id")
    return groups.agg(F.lit("groups").alias("what"), F.count_distinct("component").alias("n")).unionByName(
        matching.sessions_apart(timed).agg(F.lit("apart").alias("what"), F.count("*").alias("n")))


def members_by_real_event(t):
    """Members of known groups, for the merge operators."""
    return t.listings.withColumns({
        "group_id": F.col("real_id"), "member_id": keys.fingerprint(F.col("source"), F.col("pos").cast("string"))})


_AMOUNTS = r"regexp_extract_all(price, '(\d+(?:\.\d+)?)', 1)"
_SPEC = {
    "start_dt": "case when strftime(start_dt, '%H:%M:%S') <> '00:00:00' then 1 else 0 end",
    "venue_address": "length(venue_address)",
    "price": f"case when len({_AMOUNTS}) = 1 then 3 when len({_AMOUNTS}) > 1 then 2 else 1 end",
}
_FIELDS = ("title", "description", "start_dt", "venue_name", "venue_address", "price", "register_url", "url")


def _best(field, what):
    ok = f"start_dt is not null" if field == "start_dt" else f"trim({field}) <> ''"
    return (f"arg_min({what}, struct_pack(a := {PRIORITY}, b := -({_SPEC.get(field, '0')}), c := pos)) "
            f"filter ({ok} and {field} is not null)")


_MERGED = "merged as (select real_id as group_id, " + ", ".join(
    f"{_best(f, f)} as {f}, {_best(f, 'source')} as {f}_source" for f in _FIELDS) + " from listings group by real_id)"


@register("a3_survivorship", f"with {_MERGED} select group_id, " + ", ".join(
    (f"cast({f} as varchar) as {f}" if f == "start_dt" else f) + f", {f}_source" for f in _FIELDS) + " from merged", L)
def a3_survivorship(t):
    m = merging.survivorship(members_by_real_event(t))
    return m.select("group_id", *_FIELDS, *[
        F.try_element_at("provenance", F.lit(f)).alias(f"{f}_source") for f in _FIELDS])


@register("w2_field_rank", f"""
select real_id as group_id, source || ':' || pos as member_id, price as value, row_number() over (partition by real_id order by {PRIORITY}, {_SPEC['price']} desc, pos) as rank
from listings where trim(price) <> ''""", L)
def w2_field_rank(t):
    return merging.field_rank(members_by_real_event(t), "price").withColumn("rank", F.col("rank").cast("bigint"))


@register("a5_group_summary", """
select real_id as group_id, count(*) as n_members, array_to_string(list_sort(list(distinct source)), ',') as sources,
  coalesce(max(case when pos % 3 = 0 then cast(pos % 11 as double) end), 0.0::double) as best_relevance from listings group by real_id""", L)
def a5_group_summary(t):
    m = members_by_real_event(t).withColumn("relevance_avg", F.expr("case when pos % 3 = 0 then cast(pos % 11 as double) end"))
    return merging.group_summary(m).withColumn("sources", F.array_join("sources", ","))


@register("u2_merge_invariants", "select rule, 0::bigint as violations from (values ('missing'), ('added'), ('twice'), ('provenance_keys'), ('altered_values')) v(rule)")
def u2_merge_invariants(t):
    m = members_by_real_event(t)
    return merging.merge_invariants(m, m, merging.survivorship(m))


@register("u3_distinct_ordered", """
with o as (select real_id, coalesce(list(price order by pos) filter (where price is not null), []) as prices from listings group by real_id)
select real_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(prices), lambda p: {'i': list_position(prices, p), 'p': p})), lambda x: x.p), ',') as prices from o""", L)
def u3_distinct_ordered(t):
    at = F.sort_array(F.collect_list(F.when(F.col("price").isNotNull(), F.struct("pos", "price"))))
    four = t.listings.groupBy("real_id").agg(at.alias("l"))
    return four.select("real_id", F.array_join(F.array_distinct("l.price"), ",").alias("prices"))


_PRICES = "case pos % 6 when 0 then 'Free' when 1 then 'from ' || price when 2 then price || ' - $1,250.50' when 3 then 'suggested donation' when 4 then price || ' (members free)' else price end"


@register("f15_price_parts", rf"""
with p as (select pos, {_PRICES} as shown from listings),
a as (select pos, shown, list_transform(regexp_extract_all(replace(coalesce(shown, ''), '1,250', '1250'), '(\d+(?:\.\d+)?)', 1), lambda x: cast(x as double)) as am, regexp_matches(coalesce(shown, ''), '(?i)\bfree\b') as free from p)
select pos, case when free then 0.0::double else list_min(am) end as low, case when len(am) > 0 then list_max(am) when free then 0.0::double end as high,
  free or (len(am) > 0 and list_max(am) = 0) as is_free, len(am) = 0 and not free as ambiguous from a""", L)
def f15_price_parts(t):
    p = price.price_parts(F.expr(_PRICES))
    return t.listings.select("pos", p["low"].cast("double").alias("low"), p["high"].cast("double").alias("high"),
                             p["is_free"].alias("is_free"), p["ambiguous"].alias("ambiguous"))


# --- enrichment ---------------------------------------------------------------------------

_GAZ = """gaz as (select distinct lower(venue_name || ', ' || venue_address) as query, 47.38 + (real_id % 50) * 0.0091e0 as lat, -122.30 - (real_id % 7) * 0.01e0 as lon from listings where real_id % 5 <> 0)"""


def gazetteer(t):
    return t.listings.filter("real_id % 5 <> 0").selectExpr(
        "lower(concat(venue_name, ', ', venue_address)) as query", "47.38 + (real_id % 50) * 0.0091e0 as lat",
        "-122.30 - (real_id % 7) * 0.01e0 as lon").groupBy("query").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))


_GAZ = _GAZ.replace("select distinct", "select").replace("47.38 +", "min(47.38 +").replace("* 0.0091e0 as lat", "* 0.0091e0) as lat").replace(
    "-122.30 - (real_id % 7) * 0.01e0 as lon", "min(-122.30 - (real_id % 7) * 0.01e0) as lon").replace("where real_id % 5 <> 0", "where real_id % 5 <> 0 group by 1")


@register("j8_geocode_lookup", f"""
with {_GAZ} select pos, round(lat, 6) as found_lat, round(lon, 6) as found_lon from listings left join (select * from gaz where lat between 47.40 and 47.80 and lon between -122.55 and -122.10) g
on g.query = lower(venue_name || ', ' || venue_address)""", L)
def j8_geocode_lookup(t):
    return enrichment.geocode_lookup(t.listings, gazetteer(t)).select("pos", "found_lat", "found_lon")


_HOODS = ["Ballard", "U-District", "the Ave", "SLU", "Belltown", "Pioneer  Square", "Downtown Seattle", "Uptown", "sodo", "Greenlake", "Interbay", "", "Van Asselt"]
_HOOD = "(case cast(c_custkey % 13 as int) " + " ".join(f"when {i} then {q(h)}" for i, h in enumerate(_HOODS)) + " end)"
_LIB = f"""lib as (select name, url, description, {name_key('name')} as key from {values(K.IMAGE_LIBRARY, ['name', 'url', 'description'], 'v')}),
al as (select * from {values(list(K.NEIGHBORHOOD_ALIASES.items()), ['key', 'alias_of'], 'v')})"""


def _dims(t):
    return enrichment.library_frame(t.spark), enrichment.alias_frame(t.spark)


@register("j9_canonical_neighborhood", f"""
with {_LIB}, a as (select c_custkey, case when c_nationkey % 3 = 0 then {_HOOD} end as suburb, {_HOOD} as neighbourhood, case when c_nationkey % 4 = 0 then 'Bellevue' when c_nationkey % 4 = 1 then 'Seattle' end as city from customer),
r as (select c_custkey, case when city is null or contains(lower(city), 'seattle') then coalesce(nullif(trim(suburb), ''), nullif(trim(neighbourhood), '')) end as raw from a)
select c_custkey, coalesce((select name from lib where lib.key = {name_key('raw')} and name <> 'default'), (select alias_of from al where al.key = {name_key('raw')}), raw) as neighborhood from r""")
def j9_canonical_neighborhood(t):
    a = t.customer.selectExpr("c_custkey", f"case when c_nationkey % 3 = 0 then {_HOOD} end as suburb", f"{_HOOD} as neighbourhood",
                              "case when c_nationkey % 4 = 0 then 'Bellevue' when c_nationkey % 4 = 1 then 'Seattle' end as city")
    return enrichment.neighborhood_of(a, *_dims(t)).select("c_custkey", "neighborhood")


_DEFAULT = next(r for r in K.IMAGE_LIBRARY if r[0] == "default")


@register("j10_stock_image", f"""
with {_LIB}, c as (select c_custkey, {_HOOD} as hood from customer),
n as (select c_custkey, hood, coalesce((select name from lib where lib.key = {name_key('hood')} and name <> 'default'), (select alias_of from al where al.key = {name_key('hood')})) as canon from c),
e as (select n.*, lib.url, lib.description from n left join lib on lib.key = {name_key("coalesce(canon, hood)")} and lib.name <> 'default' and lib.url is not null)
select c_custkey, coalesce(url, {q(_DEFAULT[1])}) as stock_url, coalesce(description, {q(_DEFAULT[2])}) || {q(' ' + K.IMAGE_DISCLAIMER)} as stock_alt from e""")
def j10_stock_image(t):
    c = t.customer.selectExpr("c_custkey", f"{_HOOD} as neighborhood")
    return enrichment.stock_image(c, *_dims(t)).select("c_custkey", "stock_url", "stock_alt")


@register("f21_build_alt", f"""
select pos, case when trim(description) <> '' then description || '.' when pos % 2 = 0 then 'Street view in ' || venue_name || ', Seattle.' else 'View of Seattle.' end || {q(' ' + K.IMAGE_DISCLAIMER)} as alt
from (select pos, venue_name, trim(regexp_replace(description, '\\s+', ' ', 'g')) as description from listings)""", L)
def f21_build_alt(t):
    return t.listings.select("pos", enrichment.build_alt(
        F.col("description"), F.expr("if(pos % 2 = 0, venue_name, null)")).alias("alt"))


_EV = "ev as (select real_id as event_id, min(venue_name) as venue_name, min(venue_address) as venue_address from listings group by real_id)"


@register("j11_enrich_events", f"""
with {_GAZ}, {_LIB}, {_EV}, {STOPS},
g as (select event_id, venue_name, case when event_id % 9 = 0 then 47.61e0 else round(x.lat, 6) end as lat, case when event_id % 9 = 0 then -122.33e0 else round(x.lon, 6) end as lon
  from ev left join (select * from gaz where lat between 47.40 and 47.80 and lon between -122.55 and -122.10) x on x.query = lower(venue_name || ', ' || venue_address)),
h as (select *, case when lat is not null and lat < 47.6 then 'Belltown' when lat is not null then 'Ballard' end as neighborhood from g),
i as (select *, case when event_id % 6 = 0 then 'https://venue.example/' || event_id || '.jpg' when neighborhood = 'Belltown' then (select url from lib where name = 'Belltown') else {q(_DEFAULT[1])} end as image_url,
  case when event_id % 6 = 0 then 'venue_site' else 'stock_neighborhood' end as image_source from h),
site as (select distinct lat as plat, lon as plon from i where lat is not null),
near as (select plat, plon, s.*, {HAVERSINE.format(a='p', b='s.')} as d from site p join stops s on abs(s.lat - plat) <= 5000 / 111320.0e0 and abs(s.lon - plon) <= 5000 / (111320.0e0 * cos(radians(plat)))),
ring1 as (select * from near where d <= 1500 and abs(lat - plat) <= 1500 / 111320.0e0 and abs(lon - plon) <= 1500 / (111320.0e0 * cos(radians(plat)))),
cand as (select * from ring1 union all select * from near where d <= 5000 and (plat, plon) not in (select (plat, plon) from ring1)),
best as (select plat, plon, arg_min(stop_name, (cast(round_even(d, 0) as int), stop_name)) as first_stop, least(count(distinct stop_name), 3) as n_stops from cand group by all)
select event_id, lat, lon, neighborhood, image_url, image_source, case when event_id % 10 = 1 then 'Kept' else first_stop end as first_stop, case when event_id % 10 = 1 then 1 else n_stops end as n_stops from i left join best on plat = lat and plon = lon""", L + G)
def j11_enrich_events(t):
    ev = t.listings.groupBy(F.col("real_id").alias("event_id")).agg(
        F.min("venue_name").alias("name"), F.min("venue_address").alias("address"))
    known = F.expr("event_id % 9 = 0")
    events = ev.select("event_id", F.struct(
        "name", "address", F.when(known, F.lit(47.61)).alias("latitude"), F.when(known, F.lit(-122.33)).alias("lng"),
        F.concat(F.lit("https://venue.example/"), F.col("event_id")).alias("website")).alias("venue"),
        F.expr("""if(event_id % 10 = 1, '[{"stop_name": "Kept"}]', '[]')""").alias("transit_json"))
    photos = ev.filter("event_id % 6 = 0").selectExpr(
        "concat('https://venue.example/', event_id) as venue_url", "concat('https://venue.example/', event_id, '.jpg') as photo_url")
    coords = enrichment.geocode_lookup(ev.withColumnsRenamed({"name": "venue_name", "address": "venue_address"}), gazetteer(t)).selectExpr(
        "coalesce(if(event_id % 9 = 0, 47.61, found_lat)) as lat", "if(event_id % 9 = 0, -122.33, found_lon) as lon").filter("lat is not null")
    places = coords.selectExpr("round(lat, 4) as lat4", "round(lon, 4) as lon4", "if(lat < 47.6, 'belltown', 'Ballard') as suburb", "'Seattle' as city").distinct()
    out = enrichment.enrich_events(events, gazetteer(t), places, photos, stops(t), *_dims(t))
    return out.select("event_id", "lat", "lon", "neighborhood", "image_url", "image_source",
                      F.col("transit")[0]["stop_name"].alias("first_stop"), F.when(
                          F.col("transit").isNotNull(), F.size("transit")).cast("bigint").alias("n_stops"))


# --- verification -------------------------------------------------------------------------

_CANON = f"""canon as (select real_id as event_id, {_best('start_dt', 'start_dt')} as c_start, {_best('start_dt', 'source')} as primary_source, {_best('venue_name', 'venue_name')} as c_venue,
  {_best('venue_address', 'venue_address')} as c_address, {_best('price', 'price')} as c_price from listings group by real_id)"""
_LOW = r"cast(regexp_extract({}, '\d+') as int)"
_CHECKED = rf"""chk as (select o.*, primary_source,
  case when fetch_ok and stated_start is not null then coalesce(cast(stated_start as date) = cast(c_start as date) and (strftime(stated_start, '%H:%M:%S') = '00:00:00' or abs(date_diff('second', stated_start, c_start)) <= 900), false) end as date_ok,
  case when fetch_ok then coalesce({venue_key('stated_venue')} = {venue_key('c_venue')} and {street_key('stated_address')} = {street_key('c_address')}, false) end as venue_ok,
  case when fetch_ok and stated_price is not null then coalesce(try_cast(regexp_extract(stated_price, '\d+') as int) = try_cast(regexp_extract(c_price, '\d+') as int), false) end as price_ok
  from observations o join canon using (event_id)),
cor as (select *, (date_ok is not null)::int + (venue_ok is not null)::int + (price_ok is not null)::int as n_stated,
  fetch_ok and (date_ok is not null)::int + (venue_ok is not null)::int + (price_ok is not null)::int >= 2 and coalesce(date_ok, true) and coalesce(venue_ok, true) and coalesce(price_ok, true) as corroborates from chk)"""
V = ("listings", "observations")


def canon(t):
    m = merging.survivorship(members_by_real_event(t))
    return m.select(F.col("group_id").alias("event_id"), "start_dt", "venue_name", "venue_address", "price",
                    F.try_element_at("provenance", F.lit("start_dt")).alias("primary_source"))


@register("j12_cross_check", f"with {_CANON}, {_CHECKED} select event_id, source, cast(stated_start as varchar) as stated_start, date_ok, venue_ok, price_ok, n_stated, corroborates from cor", V)
def j12_cross_check(t):
    return verification.cross_check(canon(t), t.observations).select(
        "event_id", "source", "stated_start", "date_ok", "venue_ok", "price_ok", "n_stated", "corroborates")


@register("a4_verification_verdict", f"""
with {_CANON}, {_CHECKED}, v as (select event_id, coalesce(bool_and(date_ok), false) as date_agrees, coalesce(bool_and(venue_ok), false) as venue_agrees, coalesce(bool_and(price_ok), false) as price_agrees,
  count(*) as n_sources, count(*) filter (corroborates) as n_corroborating, count(*) filter (corroborates and n_stated = 3 and source in ('eventbrite', 'venue_site')) as au,
  count(*) filter (status_flag is not null or (source = primary_source and not fetch_ok)) as stop, count(*) filter (source = primary_source and fetch_ok) as prim from cor group by event_id)
select event_id, coalesce(date_agrees, false) as date_agrees, coalesce(venue_agrees, false) as venue_agrees, coalesce(price_agrees, false) as price_agrees,
  coalesce(n_sources, 0) as n_sources, coalesce(n_corroborating, 0) as n_corroborating,
  case when date_agrees and venue_agrees and price_agrees and (n_corroborating >= 2 or (n_corroborating = 1 and au = 1)) and stop = 0 and prim > 0 then 'VERIFIED' else 'HELD' end as verdict from (select distinct event_id from canon) left join v using (event_id)""", V)
def a4_verification_verdict(t):
    return verification.verification_verdict(verification.cross_check(canon(t), t.observations), canon(t))
