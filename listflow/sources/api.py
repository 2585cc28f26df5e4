"""Landed API pages to listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listflow.functions import dates, structs, text
from listflow.operators import filters
from listflow.sources.listings import conform

_TEXT = "struct<text:string,html:string>"
_STAMP = "struct<utc:string,local:string>"
_PRICE = "struct<display:string>"
EVENT = (
    f"struct<id:string,url:string,name:{_TEXT},summary:string,description:{_TEXT},start:{_STAMP},end:{_STAMP},"
    "online_event:boolean,is_free:boolean,venue:struct<name:string,address:struct<localized_address_display:string,"
    "localized_multi_line_address_display:string,address_1:string,address_2:string,city:string,region:string,"
    f"postal_code:string>>,ticket_availability:struct<is_free:boolean,minimum_ticket_price:{_PRICE},"
    f"maximum_ticket_price:{_PRICE}>,logo:struct<url:string,original:struct<url:string>>>"
)


def _block(c: Column) -> Column:
    return F.coalesce(text.clean_text(c["text"]), text.strip_html(c["html"]))


def api_events(payloads: DataFrame, as_of: str, source: str = "eventbrite") -> DataFrame:
    """Listings from ``events[]`` of landed pages (``payload`` text); rows lacking a name or a
    url are dropped, and a page without the array gives nothing."""
    page = F.from_json("payload", f"struct<events:array<{EVENT}>>")
    e = payloads.select(F.posexplode(page["events"]).alias("event_pos", "e")).filter("e is not null")
    venue, address, avail = F.col("e.venue"), F.col("e.venue.address"), F.col("e.ticket_availability")
    clean = lambda n: text.clean_text(address[n])
    listed = F.nullif(F.concat_ws(", ", *[clean(n) for n in (
        "address_1", "address_2", "city", "region", "postal_code")]), F.lit(""))
    display = text.clean_text(text.first_value(
        address["localized_address_display"], address["localized_multi_line_address_display"]))
    low = text.clean_text(avail["minimum_ticket_price"]["display"])
    high = text.clean_text(avail["maximum_ticket_price"]["display"])
    free = F.coalesce(F.col("e.is_free"), F.lit(False)) | F.coalesce(avail["is_free"], F.lit(False))
    price = (F.when(free, F.lit("Free")).when(low != high, F.concat(low, F.lit(" - "), high))
             .otherwise(F.coalesce(low, high)))
    now = dates.as_ntz(as_of)
    stamp = lambda n: dates.parse_event_dt(text.first_value(F.col(f"e.{n}.utc"), F.col(f"e.{n}.local")), now)
    url = text.clean_text(F.col("e.url"))
    listing = e.select(
        F.lit(source).alias("source"), F.col("e.id").alias("source_id"), url.alias("url"),
        _block(F.col("e.name")).alias("title"),
        F.coalesce(text.clean_text(F.col("e.summary")), _block(F.col("e.description"))).alias("description"),
        stamp("start").alias("start_dt"), stamp("end").alias("end_dt"),
        F.coalesce(venue["name"], F.when(venue.isNull() & F.col("e.online_event"), "Online")).alias("venue_name"),
        F.coalesce(display, listed).alias("venue_address"), price.alias("price"), url.alias("register_url"),
        F.coalesce(text.clean_text(F.col("e.logo.original.url")), F.col("e.logo.url")).alias("image_url"),
        structs.jsonable(F.struct(F.lit("api").alias("_parser"), F.col("e").alias("event"))).alias("raw"),
        "event_pos")
    return filters.normalize_listing(conform(listing)).filter("title <> '' and url <> ''")
