"""Column helpers on written-out cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from listflow.functions import dates, geo, price, structs, text, urls

AS_OF = "2026-03-10 08:00:00"


def run(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(fn(F.col("v")).alias("o"), "i").orderBy("i").select("o").collect()]


def test_clean_text(spark):
    assert run(spark, [" a  \n b ", "  ", None, "x"], text.clean_text) == ["a b", None, None, "x"]


def test_strip_html(spark):
    got = run(spark, ["<p>One</p><p>Two &amp; 3&#8217;s</p>", "a<br/>b", "<b></b>", "&nbsp;"], text.strip_html)
    assert got == ["One Two & 3’s", "a b", None, None]


@pytest.mark.parametrize("written, expected", [
    ("2026-08-22T09:00:00-07:00", "2026-08-22 09:00:00"),
    ("2026-01-22T17:00:00Z", "2026-01-22 09:00:00"),
    ("2026-08-22", "2026-08-22 00:00:00"),
    ("2026-08-22 19:30", "2026-08-22 19:30:00"),
    ("1787414400", "2026-08-22 09:00:00"),
    ("1787414400000", "2026-08-22 09:00:00"),
    ("Sat, March 5, 2026 7:00 PM", "2026-03-05 19:00:00"),
    ("August 22, 2026", "2026-08-22 00:00:00"),
    ("Starts: Aug 22, 2026 at 7pm", "2026-08-22 19:00:00"),
    ("8/22/2026 7:05 PM", "2026-08-22 19:05:00"),
    ("8/22/26", "2026-08-22 00:00:00"),
    ("22 August 2026", "2026-08-22 00:00:00"),
    ("22/08/2026", "2026-08-22 00:00:00"),
    ("10:00 PM", "2026-03-10 22:00:00"),
    ("19:15", "2026-03-10 19:15:00"),
    ("12:00 AM", "2026-03-10 00:00:00"),
    ("Doors for March 5 2026 open at 7:30 pm sharp", "2026-03-05 19:30:00"),
    ("no date here", None),
    ("February 30, 2026", None),
    ("  ", None),
])
def test_parse_event_dt(spark, written, expected):
    got = run(spark, [written], lambda c: dates.parse_event_dt(c, dates.as_ntz(AS_OF)).cast("string"))
    assert got == [expected]


def test_roll_forward(spark):
    parse = lambda c: dates.parse_event_dt(c, dates.as_ntz(AS_OF), roll_forward=True).cast("string")
    assert run(spark, ["January 2", "March 1", "January 2, 2026"], parse) == [
        "2027-01-02 00:00:00", "2026-03-01 00:00:00", "2026-01-02 00:00:00"]
    leap = lambda c: dates.parse_event_dt(c, dates.as_ntz("2028-06-01 00:00:00"), roll_forward=True).cast("string")
    assert run(spark, ["February 29"], leap) == ["2029-02-28 00:00:00"]


def test_iso_pacific_offsets(spark):
    iso = lambda c: dates.iso_pacific(c.cast("timestamp_ntz"))
    assert run(spark, ["2026-01-05 09:00:00", "2026-07-05 09:00:00"], iso) == [
        "2026-01-05T09:00:00-08:00", "2026-07-05T09:00:00-07:00"]


def test_session_zone_does_not_matter(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    parse = lambda c: dates.parse_event_dt(c, dates.as_ntz(AS_OF)).cast("string")
    values = ["2026-01-22T17:00:00Z", "1787414400", "August 22, 2026 7:00 PM"]
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        far = run(spark, values, parse)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert far == run(spark, values, parse)


def test_split_range(spark):
    split = lambda c: dates.split_dt_range(c)
    got = run(spark, ["7:00 PM - 10:00 PM", "2026-08-15", "May 1 through May 3", "7 PM–9 PM"], split)
    assert [tuple(r) for r in got] == [
        ("7:00 PM", "10:00 PM"), ("2026-08-15", None), ("May 1", "May 3"), ("7 PM", "9 PM")]


def test_range_crosses_midnight(spark):
    df = spark.createDataFrame([("May 1, 2026 10:00 PM", "1:00 AM")], "a string, b string")
    now = dates.as_ntz("2026-04-20 00:00:00")
    end = dates.finish_range(dates.parse_event_dt(F.col("a"), now), dates.parse_event_dt(F.col("b"), now), F.col("b"))
    assert df.select(end).first()[0] == dt.datetime(2026, 5, 2, 1, 0)


def test_details_when(spark):
    assert run(spark, ["2026-08-22 09:00:00"], lambda c: dates.details_when(c.cast("timestamp_ntz"))) == [
        "Saturday, August 22, 9:00 AM"]


def test_urls(spark):
    base = F.lit("https://a.example/x/y?q=1")
    hrefs = ["/z", "z", "../w", "?p=2", "//cdn.example/i", "https://b.example/", "#top", "mailto:a@b.c", "", None]
    assert run(spark, hrefs, lambda c: urls.absolute_url(base, c)) == [
        "https://a.example/z", "https://a.example/x/z", "https://a.example/w", "https://a.example/x/y?p=2",
        "https://cdn.example/i", "https://b.example/", None, None, None, None]
    assert run(spark, ["HTTP://Host.Example/Path/?q#f", "host.example/Path"], urls.url_key) == [
        "host.example/Path", "host.example/Path"]
    assert run(spark, ["a.b.example.com", "localhost", ""], urls.registrable_domain) == ["example.com", "localhost", ""]


def test_title_tokens(spark):
    titles = ["Saturday: The Green Lake Run", "Yoga in the Park presented by Gym Co", "Rowing Tickets 2026",
              "Free Community Market", "August 22 Night Ride"]
    assert run(spark, titles, text.title_tokens) == [["green", "lake"], ["park"], ["rowing"], [], []]


def test_venue_and_street_keys(spark):
    assert run(spark, ["Green Lake Park", "the green lake park (north lot)", "!!"], text.venue_key) == [
        "green lake park", "green lake park", None]
    assert run(spark, ["7201 E Green Lake Dr N, Seattle", "Somewhere"], text.street_key) == ["7201 e green lake dr n", None]


def test_prices(spark):
    parts = run(spark, ["$25", "from $25", "$25-$40", "Free", "$0", "sliding scale", "$1,250.50", None], price.price_parts)
    low = [None if p["low"] is None else float(p["low"]) for p in parts]
    assert low == [25.0, 25.0, 25.0, 0.0, 0.0, None, 1250.5, None]
    assert [p["ambiguous"] for p in parts] == [False] * 5 + [True, False, True]
    same = lambda other: lambda c: price.price_agrees(c, F.lit(other))
    assert run(spark, ["from $25", "$35", "$25-$40", "donation"], same("$25")) == [True, False, True, False]
    assert run(spark, ["Free", "$10"], same("$0")) == [True, False]


def test_format_amount(spark):
    assert run(spark, ["0", "35.00", "12.50", "Donation", None, "100"], price.format_amount) == [
        "Free", "$35", "$12.5", "Donation", None, "$100"]


def test_natural_sort(spark):
    got = run(spark, [["E Line", "10", "2", "2", "", "1 Line", None]], geo.natural_route_sort, "array<string>")
    assert got == [["1 Line", "2", "10", "E Line"]]


def test_extract_json(spark):
    texts = ['{"a":1}', 'x ```json\n{"a":2}\n``` y', 'Sure: {"a":3}. Bye', "[1,2] ok", "none"]
    got = run(spark, texts, lambda c: F.to_json(structs.extract_json_payload(c)))
    assert got == ['{"a":1}', '{"a":2}', '{"a":3}', "[1,2]", None]


def test_slug_keeps_its_cut(spark):
    got = run(spark, ["Gas Works 5K!", "a" * 59 + " b c"], lambda c: text.slugify(c, F.lit("2026-08-22").cast("timestamp_ntz")))
    assert got == ["gas-works-5k-2026-08-22", "a" * 59 + "--2026-08-22"]


def test_attempt_counters(spark):
    df = spark.createDataFrame([({"s4_write": 1, "s7_eic": 2},), (None,)], "m map<string,int>")
    bumped = [r[0] for r in df.select(structs.attempt_bump(F.col("m"), F.lit("s4_write"))).collect()]
    assert bumped == [{"s4_write": 2, "s7_eic": 2}, {"s4_write": 1}]
    reset = [r[0] for r in df.select(structs.attempt_reset(F.col("m"), F.lit("s4_write"))).collect()]
    assert reset == [{"s7_eic": 2}, {}]


def test_text_in_even_blanks_stays_as_it_is(spark):
    rows = ["a b", " a  b ", "a\tb", "a  b", " a\x1cb\n", " \t", "\x1f", "", None, "a\n\nb c"]
    assert run(spark, rows, text.collapse) == ["a b", "a b", "a b", "a b", "a b", "", "", "", None, "a b c"]
    assert run(spark, rows, text.is_blank) == [False] * 5 + [True] * 4 + [False]


def test_whole_words_by_their_longest_word(spark):
    rows = ["Sound  BATH tonight", "sound bathing", "a pop-up bar", "bar", "no spas", "cafÉ x", "café x", "", None]
    terms = ["sound bath", "pop-up", "spa", "café x"]
    assert run(spark, rows, lambda c: text.contains_any_word(c, terms)) == [
        True, False, True, False, False, False, True, False, None]


def test_keyword_groups_are_matched_once(spark):
    from listflow.operators import filters

    df = spark.createDataFrame([(1, "Yoga run", None), (2, "Casino run", ""), (3, "Chess", "x")], "id int, title string, description string")
    for mode in ("word", "substring"):
        kept = filters.keyword_filter(df, mode=mode)
        assert [(r.id, r.keyword_groups) for r in kept.collect()] == [(1, ["fitness", "wellness"])]
        assert kept._jdf.queryExecution().optimizedPlan().toString().count("powerlifting") <= 2


def test_collapse_meets_every_kind_of_whitespace(spark):
    import random
    import re
    from listflow.functions import text
    rng = random.Random(3)
    marks = ["a", "Z", "~", "é", "\U0001f600", "​", " ", " ", " ", *"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0      　"]
    said = ["".join(rng.choice(marks) for _ in range(rng.randrange(9))) for _ in range(3000)]
    got = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, s string").select("i", text.collapse(F.col("s")).alias("c")).collect()
    assert [r["c"] for r in sorted(got)] == [re.sub(r"[\s\x1c-\x1f]+", " ", s).strip(" ") for s in said]
