"""Checked queries: dates, feeds, structured data, cards, API pages, details and pictures.

Landed bodies are derived in Spark from the listings (four per body), so the expected listings
are known.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from listflow import constants as K
from listflow.checks.fixtures import AS_OF
from listflow.checks.registry import register
from listflow.checks.sqlparts import NOW, clean, q
from listflow.functions import dates, price
from listflow.operators import filters
from listflow.sources import api, cards, details, feeds, images, jsonld

L = ("listings",)

_SHAPES = {
    1: "yyyy-MM-dd HH:mm", 3: "MMMM d, yyyy h:mm a", 4: "EEEE, MMMM d, yyyy", 5: "M/d/yyyy h:mm a",
    6: "d MMMM yyyy", 7: "MMM d h:mm a", 8: "h:mm a", 10: "'Doors for' MMMM d yyyy 'open at' h:mm a 'sharp'",
    12: "'Starts: 'EEE, MMM d, yyyy h:mma", 13: "yyyy/MM/dd",
}


def _shown(c):
    """The start written in one of fourteen ways."""
    k = F.col("pos") % 14
    utc = dates.utc_from_pacific(c)
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), utc)
    out = F.when(k == 0, dates.iso_pacific(c)).when(k == 2, seconds.cast("string")).when(
        k == 9, F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 11, F.lit("time to be announced"))
    for i, shape in _SHAPES.items():
        out = out.when(k == i, F.date_format(c, shape))
    return out


@register("f6_parse_event_dt", f"""
select pos, cast(case when pos % 14 in (4, 6, 13) then date_trunc('day', start_dt) when pos % 14 = 11 then null
  when pos % 14 = 8 then date_trunc('day', {NOW}) + (start_dt - date_trunc('day', start_dt)) else start_dt end as varchar) as parsed from listings""", L)
def f6_parse_event_dt(t):
    shown = t.listings.select("pos", _shown(F.col("start_dt")).alias("shown"))
    return shown.select("pos", dates.parse_event_dt(F.col("shown"), dates.as_ntz(AS_OF)).alias("parsed"))


@register("f6_roll_forward", f"""
select pos, cast(case when start_dt < date_trunc('day', timestamp '2024-04-01 00:00:00') - interval 45 day then start_dt + interval 1 year else start_dt end as varchar) as parsed
from listings""", L)
def f6_roll_forward(t):
    shown = t.listings.select("pos", F.date_format("start_dt", "MMM d h:mm a").alias("shown"))
    return shown.select("pos", dates.parse_event_dt(
        F.col("shown"), dates.as_ntz("2024-04-01 00:00:00"), roll_forward=True).alias("parsed"))


_END_ON_ANCHOR = f"date_trunc('day', {NOW}) + ((start_dt + interval 5 hour) - date_trunc('day', start_dt + interval 5 hour))"


@register("f7_parse_dt_range", f"""
with e as (select pos, start_dt, {_END_ON_ANCHOR} as a, date_trunc('day', start_dt) + ((start_dt + interval 5 hour) - date_trunc('day', start_dt + interval 5 hour)) as d from listings)
select pos, cast(start_dt as varchar) as start_dt, cast(case when pos % 3 = 2 then null when a >= start_dt then a when d < start_dt then d + interval 1 day else d end as varchar) as end_dt from e""", L)
def f7_parse_dt_range(t):
    end = F.date_format(F.col("start_dt") + F.expr("interval 5 hours"), "h:mm a")
    shown = F.concat(F.date_format("start_dt", "MMMM d, yyyy h:mm a"), F.expr(
        "case pos % 3 when 0 then ' – ' when 1 then ' to ' else '' end"), F.when(F.col("pos") % 3 < 2, end).otherwise(""))
    now = dates.as_ntz(AS_OF)
    rows = t.listings.select("pos", dates.split_dt_range(shown).alias("s"))
    parsed = rows.select("pos", "s", dates.parse_event_dt(F.col("s.start_text"), now, True).alias("start_dt"),
                         dates.parse_event_dt(F.col("s.end_text"), now, True).alias("_end"))
    return parsed.select("pos", "start_dt", dates.finish_range(
        F.col("start_dt"), F.col("_end"), F.col("s.end_text")).alias("end_dt"))


@register("f16_format_amount", """
select pos, case pos % 6 when 0 then 'Free' when 1 then '$' || (pos % 90 + 10) when 2 then '$' || (pos % 90 + 10) || '.5' when 3 then 'EUR ' || (pos % 90 + 10) || '.25' when 4 then 'Donation' else null end as shown from listings""", L)
def f16_format_amount(t):
    value = F.expr("case pos % 6 when 0 then '0.00' when 1 then concat(pos % 90 + 10, '.0') when 2 then concat(pos % 90 + 10, '.50') when 3 then concat(pos % 90 + 10, '.25') when 4 then 'Donation' end")
    currency = F.expr("if(pos % 6 = 3, 'EUR', null)")
    return t.listings.select("pos", price.format_amount(value, currency).alias("shown"))


def _bundle(t, body, sep=""):
    """One landed body per four listings, in listing order."""
    rows = t.listings.withColumn("body", body)
    ordered = F.sort_array(F.collect_list(F.struct("pos", "body")))
    return rows.groupBy("real_id").agg(F.array_join(ordered["body"], sep).alias("body"))


_WHEN = "date_format(start_dt, 'yyyy-MM-dd HH:mm')"


@register("s2_feed_entries", f"""
select 'https://feeds.example/' || (real_id % 3) || '/rss' as feed_url, 'feeds' as source, 'id-' || pos as source_id, 'https://feeds.example/e/' || pos as url, {clean('title')} || ' & more' as title,
  'Body of ' || pos || ' <3' as description, cast(start_dt as varchar) as start_dt, {clean('venue_name')} as venue_name, {clean('venue_address')} as venue_address, price,
  case when pos % 3 = 0 then 'https://feeds.example/reg/' || pos end as register_url,
  case pos % 4 when 0 then 'https://img.example/m' || pos || '.jpg' when 1 then 'https://img.example/e' || pos || '.jpg' when 2 then 'https://feeds.example/i' || pos || '.jpg' end as image_url from listings""", L)
def s2_feed_entries(t):
    item = F.expr(f"""concat('<item><title><![CDATA[', title, ' & more]]></title>',
      if(pos % 2 = 0, concat('<link>/e/', pos, '</link>'), concat('<link rel="alternate" href="https://feeds.example/e/', pos, '"/>')),
      '<guid isPermaLink="false">id-', pos, '</guid>',
      '<description>', if(pos % 4 = 2, concat('&lt;p&gt;&lt;img src="/i', pos, '.jpg"&gt;'), '&lt;p&gt;'), 'Body of ', pos, ' &amp;lt;3&lt;/p&gt;</description>',
      if(pos % 4 = 0, concat('<media:content url="https://img.example/m', pos, '.jpg"/>'), ''),
      if(pos % 4 = 1, concat('<enclosure type="image/jpeg" url="https://img.example/e', pos, '.jpg" length="1"/>'), ''),
      if(start_dt is null, '', concat('<ev:startdate>', {_WHEN}, '</ev:startdate>')),
      '<ev:location>', venue_name, '</ev:location><address>', venue_address, '</address>',
      if(price is null, '<cost> </cost>', concat('<cost>', price, '</cost>')),
      if(pos % 3 = 0, concat('<ticket_url>/reg/', pos, '</ticket_url>'), ''), '<extra:mood>calm</extra:mood></item>',
      if(pos % 5 = 0, '<item><title>No link</title></item>', ''))""")
    landed = _bundle(t, item).select(
        F.expr("concat('https://feeds.example/', real_id % 3, '/rss')").alias("feed_url"), F.lit(None).cast("string").alias("source"),
        F.concat(F.lit("<rss><channel><title>City feed</title><link>https://feeds.example</link>"), "body", F.lit("</channel></rss>")).alias("body"))
    return feeds.feed_entries(landed, AS_OF).select(
        "feed_url", "source", "source_id", "url", "title", "description", "start_dt", "venue_name", "venue_address", "price",
        "register_url", "image_url")


_PAGE = "'https://site.example/p/' || page_id"


@register("s3_jsonld_nodes", "select page_id, 'Run ' || page_id as name, 'SportsEvent' as kind from pages_jsonld where page_id % 3 = 0", ("pages_jsonld",))
def s3_jsonld_nodes(t):
    return jsonld.jsonld_nodes(t.pages_jsonld).select(
        "page_id", F.try_variant_get("node", "$.name", "string").alias("name"), F.try_variant_get("node", "$['@type']", "string").alias("kind"))


_OFFERS = """case pos % 6 when 0 then '[{{"lowPrice":"10","highPrice":25.50,"url":"/buy/' {c} pos {c} '"}}]' when 1 then '[{{"price":0}},{{"price":"35.00","priceCurrency":"USD"}}]'
  when 2 then '{{"price":"12.5","priceCurrency":"EUR"}}' when 3 then '[{{"price":"20"}},{{"price":"40"}},{{"price":"20"}}]' when 4 then '[{{"priceSpecification":{{"price":"15"}}}}]' else '"Donation"' end"""
_PLACE = """case pos % 4 when 0 then '{{"name":"' {c} venue_name {c} '","address":{{"streetAddress":"' {c} (100 + pos % 50) {c} ' Pine St","addressLocality":"Seattle","addressRegion":"WA","postalCode":"98101"}}}}'
  when 1 then '"Gas Works Park"' when 2 then '{{"@type":"VirtualLocation","url":"https://zoom.example/' {c} pos {c} '"}}' else '[{{"name":"Hall","address":"' {c} pos {c} ' Main St"}}]' end"""


def _nodes(t):
    c = "||"
    body = F.expr(f"""'{{"@type":["Thing","MusicEvent"],"@id":"id-' || pos || '","name":"' || title || '","url":"/e/' || pos || '","startDate":"' || coalesce({_WHEN}, '') || '","image":[{{"url":"/i/' || pos || '.jpg"}}],"description":"<p>A &amp; b</p>","location":' || {_PLACE.format(c=c)} || ',"offers":' || {_OFFERS.format(c=c)} || '}}'""")
    wrapped = F.expr("""case when real_id % 2 = 0 then concat('{"@graph":[{"@type":"ItemList","itemListElement":[', body, ']},{"@type":"EventSeries","name":"no"}]}') else concat('[', body, ']') end""")
    return _bundle(t, body, ",").select(
        F.col("real_id").alias("page_id"), F.expr("concat('https://site.example/p/', real_id)").alias("url"),
        F.concat(F.lit("<html><script type=\"application/ld+json\">{oops</script><script type='application/ld+json'>"), wrapped,
                 F.lit("</script></html>")).alias("html"))


_EXP_PRICE = "case pos % 6 when 0 then '$10 - $25.5' when 1 then 'Free - $35' when 2 then 'EUR 12.5' when 3 then '$20 - $40' when 4 then '$15' end"
_EXP_VENUE = f"case pos % 4 when 0 then {clean('venue_name')} when 1 then 'Gas Works Park' when 2 then 'Online' else 'Hall' end"
_EXP_ADDR = "case pos % 4 when 0 then (100 + pos % 50) || ' Pine St, Seattle, WA 98101' when 2 then 'https://zoom.example/' || pos when 3 then pos || ' Main St' end"


@register("s3_jsonld_events", f"""
select 'id-' || pos as source_id, 'https://site.example/e/' || pos as url, {clean('title')} as title, 'A & b' as description, cast(start_dt as varchar) as start_dt,
  {_EXP_VENUE} as venue_name, {_EXP_ADDR} as venue_address, {_EXP_PRICE} as price, case when pos % 6 = 0 then 'https://site.example/buy/' || pos end as register_url, 'https://site.example/i/' || pos || '.jpg' as image_url from listings""", L)
def s3_jsonld_events(t):
    return jsonld.jsonld_events(_nodes(t), AS_OF, "venue_site").select(
        "source_id", "url", "title", "description", "start_dt", "venue_name", "venue_address", "price", "register_url", "image_url")


@register("s6_jsonld_location_price", f"select 'id-' || pos as id, {_EXP_VENUE} as venue_name, {_EXP_ADDR} as venue_address, {_EXP_PRICE} as price from listings", L)
def s6_jsonld_location_price(t):
    n = jsonld.jsonld_nodes(_nodes(t))
    return n.select(F.try_variant_get("node", "$['@id']", "string").alias("id"), jsonld.jsonld_location(F.col("node")).alias("l"),
                    jsonld.jsonld_price(F.col("node")).alias("p")).select("id", "l.venue_name", "l.venue_address", "p.price")


@register("s6_jsonld_price_pages", "select page_id, '$10 - $25' as price from pages_jsonld where page_id % 3 = 0", ("pages_jsonld",))
def s6_jsonld_price_pages(t):
    return jsonld.jsonld_nodes(t.pages_jsonld).select("page_id", jsonld.jsonld_price(F.col("node"))["price"].alias("price"))


_HOSTS = ["visitseattle.org", "www.seattle.gov", "do206.com", "everout.com"]
_SITES = ["visitseattle", "seattlegov", "do206", "thestranger"]
_SITE = "case real_id % 4 " + " ".join(f"when {i} then {q(s)}" for i, s in enumerate(_SITES)) + " end"
_HOST = "case real_id % 4 " + " ".join(f"when {i} then {q(s)}" for i, s in enumerate(_HOSTS)) + " end"


@register("s4_listing_cards", f"""
select {_SITE} as source, case when real_id % 4 = 2 then 'c' || pos else 'https://' || {_HOST} || '/e/' || pos end as source_id, 'https://' || {_HOST} || '/e/' || pos as url, {clean('title')} as title,
  cast(start_dt as varchar) as start_dt, cast(case when real_id % 4 = 3 then start_dt + interval 1 hour end as varchar) as end_dt, {clean('venue_name')} as venue_name, case when real_id % 4 <> 2 then price end as price,
  'https://' || {_HOST} || '/i' || pos || '.jpg' as image_url from listings where real_id % 5 <> 0""", L)
def s4_listing_cards(t):
    day = "date_format(start_dt, 'MMMM d, yyyy h:mm a')"
    card = F.expr(f"""case real_id % 4
      when 0 then concat('<div class="event-item big"><a href="#top">x</a><h3><a href="/e/', pos, '">', title, '</a></h3><time datetime="', coalesce({_WHEN}, ''), '">soon</time><span class="venue"> ', venue_name, '</span><b class="price">', coalesce(price, ''), '</b><img src="/i', pos, '.jpg"></div>')
      when 1 then concat('<li class="views-row"><div class="field--name-title"><a href="/e/', pos, '">', title, '</a></div><p class="date">', coalesce({day}, ''), '</p><p class="venue">', venue_name, '</p><p class="cost">', coalesce(price, ''), '</p><img data-src="/i', pos, '.jpg"/></li>')
      when 2 then concat('<article data-event-id="c', pos, '"><a class="ds-listing-event-title" href="/e/', pos, '"><span class="ds-listing-event-title-text">', title, '</span></a><div class="ds-event-time">', coalesce({day}, ''), '</div><div class="ds-venue-name">', venue_name, '</div><img src="/i', pos, '.jpg"></article>')
      else concat('<div class="event"><div class="event-title"><a href="/e/', pos, '">', title, '</a></div><div class="event-date">', coalesce(concat({day}, ' – ', date_format(start_dt + interval 1 hour, 'MMMM d, yyyy h:mm a')), ''), '</div><div class="location-name">', venue_name, '</div><i class="event-price">', coalesce(price, ''), '</i><img src="/i', pos, '.jpg"></div>') end""")
    pages = _bundle(t, card).select(
        F.col("real_id").alias("page_id"), F.concat(F.lit("https://"), F.expr(_HOST), F.lit("/list")).alias("url"),
        F.concat(F.lit("<html><body><nav><a href='/'>home</a></nav>"), "body", F.expr(
            "if(real_id % 5 = 0, '<script type=\"application/ld+json\">{\"@type\":\"Event\",\"name\":\"x\"}</script>', '')"), F.lit("</body></html>")).alias("html"))
    found = jsonld.jsonld_nodes(pages).select("page_id")
    return cards.listing_cards(pages, cards.site_specs(t.spark), AS_OF, found).select(
        "source", "source_id", "url", "title", "start_dt", "end_dt", "venue_name", "price", "image_url")


@register("s5_api_events", f"""
select 'eventbrite' as source, cast(pos as varchar) as source_id, {clean('url')} as url, {clean('title')} as title, coalesce({clean('description')}, 'Long & short') as description, cast(start_dt as varchar) as start_dt,
  case when pos % 7 = 0 then 'Online' else {clean('venue_name')} end as venue_name, case when pos % 7 = 0 then null when pos % 2 = 0 then {clean('venue_address')} else (100 + pos % 50) || ' Pine St, Seattle, WA' end as venue_address,
  case when pos % 5 = 0 then 'Free' when pos % 5 = 1 and price is not null then price || ' - $120' when pos % 5 = 1 then '$120' else price end as price, {clean('url')} as register_url, case when pos % 4 = 0 then 'https://img.example/' || pos end as image_url from listings""", L)
def s5_api_events(t):
    block = lambda text=None, html=None: F.struct(
        (F.lit(None).cast("string") if text is None else text).alias("text"), (F.lit(None).cast("string") if html is None else html).alias("html"))
    utc = F.date_format(dates.utc_from_pacific(F.col("start_dt")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    address = F.when(F.col("pos") % 2 == 0, F.struct(F.col("venue_address").alias("localized_address_display"), F.lit(None).cast("string").alias("address_1"),
                     F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("region"))).otherwise(F.struct(
                         F.lit(None).cast("string").alias("localized_address_display"), F.expr("concat(100 + pos % 50, ' Pine St')").alias("address_1"),
                         F.lit("Seattle").alias("city"), F.lit("WA").alias("region")))
    event = F.to_json(F.struct(
        F.col("pos").cast("string").alias("id"), "url", block(F.col("title")).alias("name"), F.col("description").alias("summary"),
        block(html=F.lit("<p>Long &amp; short</p>")).alias("description"), F.struct(utc.alias("utc")).alias("start"),
        F.lit(True).alias("online_event"), F.expr("pos % 5 = 0").alias("is_free"),
        F.when(F.col("pos") % 7 != 0, F.struct(F.col("venue_name").alias("name"), address.alias("address"))).alias("venue"),
        F.struct(F.struct(F.col("price").alias("display")).alias("minimum_ticket_price"), F.when(
            F.col("pos") % 5 == 1, F.struct(F.lit("$120").alias("display"))).alias("maximum_ticket_price")).alias("ticket_availability"),
        F.when(F.col("pos") % 4 == 0, F.struct(F.expr("concat('https://img.example/', pos)").alias("url"))).alias("logo")))
    pages = _bundle(t, event, ",").select(F.concat(F.lit('{"events":['), "body", F.lit(',{"id":"draft"}],"pagination":{}}')).alias("payload"))
    return api.api_events(pages, AS_OF).select(
        "source", "source_id", "url", "title", "description", "start_dt", "venue_name", "venue_address", "price", "register_url", "image_url")


_BUDGET = "b as (select * from (select *, row_number() over (partition by source order by pos) as rn from listings where start_dt is null) where rn <= 12)"


@register("w7_detail_budget", f"with {_BUDGET} select pos, source from b", L)
def w7_detail_budget(t):
    return details.detail_budget(t.listings).select("pos", "source")


@register("s7_topup_from_detail", f"""
with b as (select pos from listings where start_dt is null), m as (select l.*, b.pos is not null and l.pos % 4 <> 0 as hit, b.pos is not null as rd from listings l left join b using (pos))
select pos, title, cast(case when hit then timestamp '2024-02-01 19:00:00' else start_dt end as varchar) as start_dt, case when hit and price is null then '$77' else price end as price,
  case when hit and coalesce(description, '') = '' then 'og ' || pos else description end as description, case when hit and pos % 4 <> 0 then 'listing,detail' else 'listing' end as raw_keys from (select m.* replace (case when trim(description) = '' then '' else description end as description) from m)""", L)
def s7_topup_from_detail(t):
    own = F.create_map(F.lit("parser"), F.lit("listing"))
    rows = t.listings.withColumns({"raw": own, "url": F.concat("url", F.lit("#"), "pos"),
                                   "description": F.expr("if(trim(description) = '', '', description)")})
    found = rows.filter("pos % 4 <> 0").select(
        "url", F.lit("other title").alias("title"), F.lit("2024-02-01 19:00:00").cast("timestamp_ntz").alias("start_dt"),
        F.lit("$77").alias("price"), F.expr("concat('og ', pos)").alias("og_description"),
        F.create_map(F.lit("parser"), F.lit("detail"), F.lit("page"), F.lit("detail")).alias("raw"))
    out = details.topup_from_detail(rows, found)
    return out.select("pos", "title", "start_dt", "price", "description",
                      F.concat_ws(",", F.col("raw")["parser"], F.try_element_at("raw", F.lit("page"))).alias("raw_keys"))


def _venue_pages(t):
    return t.pages.select("page_id", "url", F.expr(r"""concat(html,
      case page_id % 4 when 0 then concat('<meta name="twitter:image" content="/t', page_id, '.png"><meta property="og:image" content="/og', page_id, '.jpg?x=1&amp;y=2">')
        when 1 then '<meta property="og:image" content="/site-logo.png"><link rel="image_src preload" href="//cdn.example.org/l.jpg">' else '' end,
      '<img class="site-logo" src="/big1.jpg" width="900" height="900"><img src="/tiny.jpg" width="120" height="80"><img src="/shot.png" width="800" height="800">',
      '<img src="https://elsewhere.test/far.jpg" width="999" height="999"><img src="https://images.elsewhere.test/cdn.jpg" width="400px" height="300">',
      case when page_id % 4 = 3 then '<img data-src="/wide.webp" width="1000" height="500" alt="Main hall">' else '<img src="/plain" alt="Hall">' end)""").alias("html"))


_ORIGIN = "regexp_extract(url, '^[a-z]+://[^/?#]*')"
_PHOTOS = f"""ph as (select page_id, 0 as tier, 1 as pos, 0 as area, {_ORIGIN} || '/og' || page_id || '.jpg?x=1&y=2' as photo_url from pages where page_id % 4 = 0
  union all select page_id, 0, 3, 0, {_ORIGIN} || '/t' || page_id || '.png' from pages where page_id % 4 = 0
  union all select page_id, 0, 5, 0, regexp_extract(url, '^[a-z]+:') || '//cdn.example.org/l.jpg' from pages where page_id % 4 = 1
  union all select page_id, 1, 4, 120000, 'https://images.elsewhere.test/cdn.jpg' from pages
  union all select page_id, 1, 5, 500000, {_ORIGIN} || '/wide.webp' from pages where page_id % 4 = 3
  union all select page_id, 1, 5, 0, {_ORIGIN} || '/plain' from pages where page_id % 4 <> 3)"""


@register("p10_photo_candidates", f"with {_PHOTOS} select page_id, tier, pos, cast(area as bigint) as area, photo_url from ph")
def p10_photo_candidates(t):
    return images.photo_candidates(_venue_pages(t))


@register("w4_best_image_per_venue", f"with {_PHOTOS} select page_id, tier, photo_url from (select *, row_number() over (partition by page_id order by tier, case when tier = 0 then 0 else -area end, pos) as rn from ph) where rn = 1")
def w4_best_image_per_venue(t):
    return images.best_image_per_venue(images.photo_candidates(_venue_pages(t)))
