"""Extraction on inline bodies."""

import re
import json

from pyspark.sql import functions as F

from listflow.sources import api, cards, details, feeds, images, jsonld
from listflow.sources import listings as src

AS_OF = "2026-08-10 08:00:00"

RSS = """<?xml version="1.0"?><rss xmlns:ev="http://purl.org/rss/1.0/modules/event/"><channel><title>City &amp; Co</title><link>https://city.example</link>
<item><title>Run &amp; Ride</title><link>/e/1</link><guid>g1</guid><description><![CDATA[<p>Join <b>us</b>.</p><img src="/a.jpg">]]></description>
<ev:startdate>2026-08-22T09:00:00-07:00</ev:startdate><ev:location>Pier &#38; Dock</ev:location><cost></cost><price>$5</price><tickets>/t/1</tickets><mood>calm</mood></item>
<item><title>No link</title></item><item><title>&nbsp;</title><link>/e/9</link></item>
<item><title>Broken <link>/e/2</link></item></channel></rss>"""
ATOM = """<feed><title>Atom</title><entry><title type="html">Yoga</title><link rel="self" href="/self"/><link rel="alternate" href="/y"/><id>y1</id>
<summary>short</summary><content type="html">&lt;p&gt;Long text&lt;/p&gt;</content><published>Sat, 15 Aug 2026 18:00:00 GMT</published>
<media:thumbnail url="https://cdn.example/y.jpg"/></entry></feed>"""


def test_feeds(spark):
    df = spark.createDataFrame([("https://www.city.example/rss", None, RSS), ("https://a.example/f", "atomic", ATOM)],
                               "feed_url string, source string, body string")
    got = {r["source_id"]: r for r in feeds.feed_entries(df, AS_OF, use_published_as_start=True).collect()}
    run = got["g1"]
    assert (run["source"], run["title"], run["url"], run["description"]) == ("city", "Run & Ride", "https://www.city.example/e/1", "Join us .")
    assert (str(run["start_dt"]), run["venue_name"], run["price"]) == ("2026-08-22 09:00:00", "Pier & Dock", "$5")
    assert (run["register_url"], run["image_url"]) == ("https://www.city.example/t/1", "https://www.city.example/a.jpg")
    raw = json.loads(run["raw"])
    assert [c["key"] for c in raw["_unmapped"]] == ["mood"] and raw["feed"]["link"] == "https://city.example"
    yoga = got["y1"]
    assert (yoga["url"], yoga["description"], str(yoga["start_dt"]), yoga["image_url"]) == (
        "https://a.example/y", "Long text", "2026-08-15 11:00:00", "https://cdn.example/y.jpg")
    assert len(got) == 2


def test_jsonld_nesting_depth_and_types(spark):
    deep = {"@type": "Event", "name": "deep"}
    for _ in range(3):
        deep = {"@graph": [deep]}          # a list and its item are one level each
    too_deep = {"@graph": [deep]}
    blocks = [
        {"@graph": [{"@type": ["Thing", "MusicEvent"], "name": "A"}, {"@type": "EventVenue", "name": "V"}]},
        [{"@type": "ItemList", "itemListElement": [{"@type": "ListItem", "item": {"type": "event", "name": "B"}}]}],
        {"@type": "Festival", "subEvent": {"@type": "SportsEvent", "name": "C"}, "events": None}, deep, too_deep]
    html = "".join(f'<SCRIPT data-x type="application/ld+json">{json.dumps(b)}</script>' for b in blocks)
    html += '<script type="application/ld+json">{bad</script><script>var x = {"@type": "Event", "name": "no"}</script>'
    pages = spark.createDataFrame([(1, "https://x.example/", html)], "page_id long, url string, html string")
    names = [r[0] for r in jsonld.jsonld_nodes(pages).select(F.try_variant_get("node", "$.name", "string")).collect()]
    assert sorted(names) == ["A", "B", "C", "deep"]


def test_jsonld_fields(spark):
    node = {"@type": "Event", "name": ["  Big  Run "], "url": {"@id": "/e/1"}, "startDate": "2026-08-22", "image": [{"contentUrl": "i.jpg"}],
            "location": [None, {"name": "Dock", "address": {"streetAddress": "1 A St", "addressRegion": "WA", "postalCode": 98101}}],
            "offers": {"lowPrice": "0", "highPrice": "30", "url": "/buy"}}
    free = {"@type": "Event", "name": "F", "isAccessibleForFree": True, "url": "https://y.example/f", "location": "Park"}
    html = "".join(f'<script type="application/ld+json">{json.dumps(n)}</script>' for n in (node, free))
    df = spark.createDataFrame([(1, "https://x.example/p/", html)], "page_id long, url string, html string")
    a, b = jsonld.jsonld_events(df, AS_OF, "venue_site").orderBy("title").collect()
    assert (a["title"], a["url"], a["venue_address"], a["price"], a["register_url"], a["image_url"]) == (
        "Big Run", "https://x.example/e/1", "1 A St, WA 98101", "Free - $30", "https://x.example/buy", "https://x.example/p/i.jpg")
    assert (b["price"], b["venue_name"], b["register_url"]) == ("Free", "Park", "https://y.example/f")


def test_cards_use_the_first_matching_selector(spark):
    html = """<article class="event"><h2>Second</h2><h3>Title <a href="/e">One</a></h3><time datetime="2026-08-22T10:00">x</time>
      <p>About it</p><div class=location>Dock<br>North</div><img data-src="b.png"></article><article><h2>No link</h2></article>
      <article><a href="/e2" title="From anchor"><img src="x.png"></a></article>"""
    pages = spark.createDataFrame([(1, "https://visitseattle.org/events/", html), (2, "https://unknown.example/", html)],
                                  "page_id long, url string, html string")
    got = cards.listing_cards(pages, cards.site_specs(spark, {"visitseattle": {"card": "article"}}), AS_OF).orderBy("url").collect()
    assert [(r["title"], r["url"]) for r in got] == [("One", "https://visitseattle.org/e"), ("From anchor", "https://visitseattle.org/e2")]
    assert (got[0]["venue_name"], got[0]["description"], str(got[0]["start_dt"]), got[0]["image_url"]) == (
        "Dock North", "About it", "2026-08-22 10:00:00", "https://visitseattle.org/events/b.png")


def test_api_pages_without_events(spark):
    df = spark.createDataFrame([('{"error": 1}',), ('{"events": null}',), ("not json",)], "payload string")
    assert api.api_events(df, AS_OF).count() == 0


def test_budget_and_fill(spark):
    rows = [(i, "s", str(i), f"https://x.example/{i}", f"T{i}", None, None) for i in range(20)]
    listings = src.conform(spark.createDataFrame(rows, "pos long, source string, source_id string, url string, title string, price string, description string"))
    found = listings.select("url", F.lit("$9").alias("price"), F.lit("other").alias("title"))
    got = details.topup_from_detail(listings, found, budget=3).orderBy("pos").collect()
    assert [r["price"] for r in got] == ["$9"] * 3 + [None] * 17 and got[0]["title"] == "T0"


def test_photo_limits(spark):
    html = '<img src="/a.jpg" width="100">' + '<img src="/b.jpg" width="300" height="200">' + '<img src="/c.jpg">' * 3
    df = spark.createDataFrame([(1, "https://x.example/", html)], "page_id long, url string, html string")
    assert images.best_image_per_venue(images.photo_candidates(df)).first()["photo_url"] == "https://x.example/b.jpg"
    many = spark.createDataFrame([(1, "https://x.example/", "".join(f'<img src="/{i}.jpg">' for i in range(250)))],
                                 "page_id long, url string, html string")
    assert images.photo_candidates(many).count() == 250


def test_markup_in_cdata_and_media_groups(spark):
    body = """<rss><channel><title>C</title><item><title><![CDATA[A < B]]></title><link>/e/1</link><guid>g1</guid>
<description><![CDATA[Ends </item> here </description> or <b>there</b>]]></description>
<media:group><media:content url="/big.jpg"/><media:title>t</media:title></media:group></item>
<item><title>Two</title><link>/e/2</link><guid>g2</guid><description><![CDATA[open]]></description></item></channel></rss>"""
    df = spark.createDataFrame([("https://c.example/rss", None, body)], "feed_url string, source string, body string")
    got = {r["source_id"]: r for r in feeds.feed_entries(df, AS_OF).collect()}
    assert set(got) == {"g1", "g2"}
    assert (got["g1"]["title"], got["g1"]["description"]) == ("A < B", "Ends here or there")
    assert got["g1"]["image_url"] == "https://c.example/big.jpg" and got["g2"]["description"] == "open"


def test_pages_of_unclosed_tags_are_read(spark):
    html = "<p>" * 5000 + '<article class="event"><h3><a href="/e">Deep</a></h3>'
    pages = spark.createDataFrame([(1, "https://visitseattle.org/events/", html)], "page_id long, url string, html string")
    specs = cards.site_specs(spark, {"visitseattle": {"card": "article"}})
    assert [r["title"] for r in cards.listing_cards(pages, specs, AS_OF).collect()] == ["Deep"]


def test_repeated_detail_urls_fill_once(spark):
    listings = src.conform(spark.createDataFrame(
        [(1, "s", "1", "https://x.example/1", "T", None)],
        "pos long, source string, source_id string, url string, title string, price string"))
    found = spark.createDataFrame([("https://x.example/1", "$9"), ("https://x.example/1", "$8")], "url string, price string")
    assert [r["price"] for r in details.topup_from_detail(listings, found).collect()] == ["$9"]


def test_zones_of_landed_times(spark):
    df = spark.createDataFrame([("z", "2026-08-22T16:00:00Z"), ("p", "2026-08-22T09:00:00-07:00"), ("e", "2026-08-22T12:00:00-04:00"),
                                ("w", "2026-08-22 09:00:00"), ("n", None), ("x", "soon")], "source_id string, start_dt string")
    got = {r[0]: r[1] and str(r[1]) for r in src.conform(df).select("source_id", "start_dt").collect()}
    assert got == {**dict.fromkeys("zpew", "2026-08-22 09:00:00"), "n": None, "x": None}
    instant = spark.sql("select timestamp'2026-08-22 16:00:00 UTC' as start_dt")
    assert str(src.conform(instant).first()["start_dt"]) == "2026-08-22 09:00:00"


def test_jsonld_text_at_any_depth(spark):
    deep = "[[[[{\"text\":{\"contentUrl\":[null,\"\",\"/buy/deep\"]}}]]]]"
    nodes = [
        '{"@type":"Event","name":{"name":[{"url":["Deep title"]}]},"url":"/e/1","offers":[{"url":%s,"price":{"name":[[{"text":"Donation"}]]}}],'
        '"location":{"name":[{"name":{"name":"Hall"}}],"address":{"streetAddress":[["1 Pine St"]],"addressLocality":{"name":"Seattle"}}}}' % deep,
        '{"@type":"Event","name":"[Sold out] {tonight}","offers":{"price":"5"},"location":"{Hall}"}',
        '{"@type":"Event","name":["",{"name":null,"url":"  "},[{"@id":"Second item"}]],"location":[null,{"@type":"VirtualLocation"}]}',
        '{"@type":"Event","name":{"description":"no name"}}']
    rows = [(i, "https://x.example/p", f'<script type="application/ld+json">{n}</script>') for i, n in enumerate(nodes)]
    out = jsonld.jsonld_events(spark.createDataFrame(rows, "page_id long, url string, html string"), AS_OF, "venue_site")
    found = [(r.title, r.price, r.register_url, r.venue_name, r.venue_address) for r in out.orderBy("title").collect()]
    assert found == [
        ("Deep title", "Donation", "https://x.example/buy/deep", "Hall", "1 Pine St, Seattle"),
        ("Second item", None, None, "Online", None),
        ("[Sold out] {tonight}", "$5", None, "{Hall}", None)]


def _plan_length(df):
    """Characters of the plan without the numbers of columns and variables, which grow with the session."""
    return len(re.sub(r"[#_]\d+L?", "", df._jdf.queryExecution().optimizedPlan().toString()))


def test_jsonld_plans_stay_small(spark):
    pages = spark.createDataFrame([(1, "https://x.example/p", "")], "page_id long, url string, html string")
    for read in (jsonld.jsonld_location, jsonld.jsonld_price):
        assert _plan_length(jsonld.jsonld_nodes(pages).select(read(F.col("node")))) < 25_000
    assert _plan_length(jsonld.jsonld_events(pages, AS_OF, "venue_site")) < 60_000


def test_jsonld_calls_of_python_are_read_once(spark):
    pages = spark.createDataFrame([(1, "https://x.example/p", "")], "page_id long, url string, html string")
    plan = jsonld.jsonld_events(pages, AS_OF, "venue_site")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_resolve(") == 3 and len(re.findall("regexp_replace|RLIKE", plan)) < 170


def test_jsonld_text_of_wide_values(spark):
    wide = [{"name": [None, {"text": " "}]}] * 40 + [[[{"url": "x", "name": [[], {"@id": "First  one"}]}]], "Later"]
    nodes = [{"@type": "Event", "name": wide, "image": [{"text": "t", "url": "/i.jpg"}], "offers": [5, [], {"price": [{"name": "7.50"}]}, {"price": "9"}]},
             {"@type": "Event", "name": "Plain", "photo": "", "image": {}, "url": None, "@id": ["", {"url": "/e"}],
              "location": {"name": "Hall", "address": ["x", {"streetAddress": {"name": "1 A St"}, "postalCode": 98101}]}},
             {"@type": None, "type": ["Thing", "event"], "name": [[], [{}]], "location": [[{"name": "no"}]]}]
    html = "".join(f'<script type="application/ld+json">{json.dumps(n)}</script>' for n in nodes)
    pages = spark.createDataFrame([(1, "https://x.example/p/", html)], "page_id long, url string, html string")
    got = [(r.title, r.url, r.price, r.image_url, r.venue_name, r.venue_address) for r in jsonld.jsonld_events(pages, AS_OF, "venue_site").orderBy("title").collect()]
    assert got == [("First one", "https://x.example/p/", "$7.5 - $9", "https://x.example/i.jpg", None, None),
                   ("Plain", "https://x.example/e", None, None, "Hall", "1 A St, 98101")]
    assert jsonld.jsonld_nodes(pages).count() == 3


def test_selector_steps_are_read_once():
    cards._steps.cache_clear()
    spec = {**{k: [] for k in ("title", "description", "venue", "address", "price", "date", "image")},
            "card": ["li.x"], "link": ["ul#u a[href]", "a[rel='n']", "a:first"]}
    page = '<ul id=u>' + '<li class="x y"><a href="/1">o</a><a rel=n>p</a></li>' * 50 + '</ul>'
    got = list(cards._cards(page, spec))
    assert [(c[0], c[2]) for c in got] == [(i, ["/1", ""]) for i in range(50)]
    assert cards._steps.cache_info().misses == 4


def test_children_are_cut_in_one_match(spark):
    cut = lambda body: [tuple(c) for c in spark.createDataFrame([(body,)], "b string").select(feeds._children(F.col("b"))).first()[0]]
    item = 'x<A:b k="1">one</A:b > y <c/><media:group><d  e=f/></media:group><g>a<h>b</h></g><open>z ﷐ \U0001f600<i></i>'
    found = [("a_b", ' k="1"', "one"), ("c", "", ""), ("d", "  e=f", ""), ("g", "", "a<h>b</h>"), ("i", "", "")]
    assert cut(item) == found and cut("plain") == [] and cut("") == []
    for mark in ("﷑", "﷒"):
        assert cut(item.replace("one", f"o{mark}ne")) == [("a_b", ' k="1"', f"o{mark}ne"), *found[1:]]


def test_feed_aliases_take_the_first_key_and_then_the_first_child(spark):
    body = """<rss><channel><title>C</title><item><title>T</title><link>/1</link><price>$3</price><cost>$1</cost><cost>$2</cost>
<admission>$4</admission><ev:cost> </ev:cost><guid>g</guid><id>i</id><street>S</street></item></channel></rss>"""
    out = feeds.feed_entries(spark.createDataFrame([("https://c.example/rss", None, body)], "feed_url string, source string, body string"), AS_OF)
    got = out.first()
    assert (got["price"], got["source_id"], got["venue_address"], got["venue_name"]) == ("$1", "i", "S", None)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("[filled]") + \
        out._jdf.queryExecution().optimizedPlan().toString().count(".filled") <= 30
