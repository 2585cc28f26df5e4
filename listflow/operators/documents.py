"""Article documents as arrays of typed nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import dates, text

NODE = ("struct<type:string,level:int,alt:string,url:string,"
        "runs:array<struct<text:string,bold:boolean>>>")
NEWLINE = "\n"


def _run(c: Column, bold: bool = False) -> Column:
    return F.struct(c.alias("text"), F.lit(bold).alias("bold"))


def _node(kind: str, runs: list[Column], level: int | None = None, alt: Column | None = None,
          url: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    made = F.array(*runs) if runs else F.array().cast("array<struct<text:string,bold:boolean>>")
    return F.struct(
        F.lit(kind).alias("type"), F.lit(level).cast("int").alias("level"),
        (none if alt is None else alt).alias("alt"), (none if url is None else url).alias("url"),
        made.alias("runs")).cast(NODE)


def paragraph(*runs: Column) -> Column:
    """A paragraph; its runs always stand between two newline runs."""
    edge = _run(F.lit(NEWLINE))
    return _node("PARAGRAPH", [edge, *runs, edge])


def _prose(c: Column) -> Column:
    return F.transform(text.paragraphs(c), lambda b: paragraph(_run(b)))


def details_box(events: DataFrame) -> DataFrame:
    """Add ``details``: ordered (label, value) lines, empty ones left out.

    The nearest stop, when there is one, adds a line after the fixed six.
    """
    have = set(events.columns)
    col = lambda n: F.col(n) if n in have else F.lit(None).cast("string")
    where = F.concat(F.coalesce(col("venue_name"), F.lit("")),
                     F.coalesce(F.concat(F.lit(", "), text.first_value(col("venue_address"))), F.lit("")))
    values = {
        "when": dates.details_when(F.col("start_dt")),
        "where": F.regexp_replace(where, r"^[, ]+|[, ]+$", ""),
        "cost": col("price"), "register": col("register_url"),
        "skill_level": col("skill_level"), "what_to_bring": col("what_to_bring"),
    }
    lines = [F.struct(F.lit(label).alias("label"), F.trim(values[k]).alias("value"))
             for k, label in K.DETAILS_LABELS]
    if "transit" in have:
        stop = F.try_element_at("transit", F.lit(1))
        shown = F.concat(stop["stop_name"], F.lit(" ("), F.array_join(F.slice(stop["routes"], 1, 3), ", "),
                         F.lit("), "), stop["distance_m"].cast("string"), F.lit("m away"))
        lines.append(F.struct(F.lit("Getting there").alias("label"), shown.alias("value")))
    return events.withColumn("details", F.filter(
        F.array(*lines), lambda x: ~text.is_blank(x["value"])))


def build_document(articles: DataFrame) -> DataFrame:
    """Add ``nodes``: hook, details, picture and spacer, headed sections, disclaimer.

    ``articles`` has hook_line, details, sections, disclaimer, image_url and image_alt.
    """
    empty = F.array().cast(f"array<{NODE}>")
    box = F.transform(F.col("details"), lambda d: paragraph(
        _run(F.concat(d["label"], F.lit(": ")), True), _run(d["value"])))
    picture = F.array(
        _node("IMAGE", [], alt=F.coalesce("image_alt", F.lit("")), url=F.col("image_url")),
        _node("PARAGRAPH", [_run(F.lit(NEWLINE))]))

    def section(s: Column) -> Column:
        heading = F.trim(F.coalesce(s["heading"], F.lit("")))
        head = F.when(heading != "", F.array(_node("HEADING", [_run(heading)], 2))).otherwise(empty)
        return F.concat(head, _prose(s["body"]))

    nodes = F.concat(
        _prose(F.col("hook_line")), F.coalesce(box, empty),
        F.when(F.coalesce("image_url", F.lit("")) != "", picture).otherwise(empty),
        F.coalesce(F.flatten(F.transform("sections", section)), empty),
        _prose(F.col("disclaimer")))
    return articles.withColumn("nodes", nodes)


def render(nodes: Column) -> Column:
    """The document as JSON."""
    return F.to_json(F.struct(nodes.alias("nodes"), F.struct(F.lit(1).alias("version")).alias("metadata")))


def extract_text(nodes: Column) -> Column:
    """All text runs in order as one string."""
    return F.array_join(F.flatten(F.transform(
        nodes, lambda n: F.transform(n["runs"], lambda r: r["text"]))), "")


def prepend_banner(nodes: Column, banner: Column) -> Column:
    """Put a bold status line first, unless one of the first two nodes already carries it."""
    there = F.contains(extract_text(F.slice(nodes, 1, 2)), banner)
    return F.when(there | banner.isNull(), nodes).otherwise(
        F.concat(F.array(paragraph(_run(banner, True))), nodes))


def body_matches(body: Column, hook: Column) -> Column:
    """Whether a stored body holds the opening of the hook, whitespace aside."""
    needle = text.collapse(F.substring(F.coalesce(hook, F.lit("")), 1, 40))
    return (needle == "") | F.contains(text.collapse(body), needle)


def seo_tags(title: Column, description: Column, suffix: str) -> Column:
    """Title and description tags; a meta tag's text stands in ``content``."""
    none = F.lit(None).cast("string")
    blank = F.lit("")
    return F.array(
        F.struct(F.lit("title").alias("type"), none.alias("name"),
                 F.concat(F.coalesce(title, blank), F.lit(suffix)).alias("children"),
                 none.alias("content")),
        F.struct(F.lit("meta").alias("type"), F.lit("description").alias("name"),
                 none.alias("children"), F.coalesce(description, blank).alias("content")))


def misplaced_meta(tags: Column) -> Column:
    """Whether a meta tag carries its text where it would render empty."""
    return F.exists(tags, lambda x: (x["type"] == "meta") & (F.coalesce(x["children"], F.lit("")) != "")
                    & (F.coalesce(x["content"], F.lit("")) == ""))


def draft_text(hook: Column, sections: Column, disclaimer: Column) -> Column:
    """Review text: hook, headed sections, disclaimer."""
    blank = F.lit("")
    parts = F.transform(sections, lambda s: F.concat(
        F.lit("\n## "), F.coalesce(s["heading"], blank), F.lit("\n\n"), F.coalesce(s["body"], blank)))
    return F.array_join(F.concat(
        F.array(F.coalesce(hook, blank)), F.coalesce(parts, F.array().cast("array<string>")),
        F.array(F.concat(F.lit("\n"), F.coalesce(disclaimer, blank)))), "\n")


def stage_metadata(drafts: DataFrame, category: str) -> DataFrame:
    """Hand-off metadata of a post."""
    return drafts.select(
        "draft_id", F.substring(F.coalesce("meta_title", F.lit("")), 1, 120).alias("title"),
        F.coalesce("meta_description", F.lit("")).alias("excerpt"),
        F.lit(category).alias("category"))
