"""Checkable text rules over drafts, judge verdicts and change logs.

A draft row has draft_id, event_id, hook_line, sections ARRAY<STRUCT<heading, body>>,
disclaimer, meta_title, meta_description, slug_stem and links ARRAY<STRING>. Whole texts are
read in place: rules are projections over the draft, and only small columns are shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import structs, text
from listflow.functions.binding import let


def bodies(sections: Column) -> Column:
    return F.transform(sections, lambda s: F.coalesce(s["body"], F.lit("")))


def body_text(sections: Column) -> Column:
    """All section bodies as one text."""
    return F.coalesce(F.array_join(bodies(sections), " "), F.lit(""))


def draft_gate(drafts: DataFrame, profile: str = "default") -> DataFrame:
    """First failing structural rule per draft: section count, prose length, em-dash.

    The ``strict`` profile counts hook and disclaimer as prose and uses the narrower band.
    """
    body = body_text(F.col("sections"))
    hook = F.coalesce("hook_line", F.lit(""))
    low, high = ((K.WORDS_MIN, K.WORDS_MAX - K.DETAILS_ALLOWANCE) if profile == "default"
                 else K.STRICT_WORDS)
    prose = body if profile == "default" else F.concat_ws(" ", hook, body, F.col("disclaimer"))
    n_sections = F.coalesce(F.size("sections"), F.lit(0))
    counted = drafts.withColumn("n_sections", n_sections).withColumn(
        "n_words", text.word_count(prose))
    reason = (
        F.when(~F.col("n_sections").between(K.SECTIONS_MIN, K.SECTIONS_MAX), F.concat(
            F.col("n_sections"), F.lit(f" sections, expected {K.SECTIONS_MIN}-{K.SECTIONS_MAX}")))
        .when(~F.col("n_words").between(low, high), F.concat(
            F.col("n_words"), F.lit(f" words of prose, expected {low}-{high}")))
        .when(F.contains(body, F.lit(K.EM_DASH)) | F.contains(hook, F.lit(K.EM_DASH)),
              F.lit("em-dash present")))
    return (counted.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull())
            .withColumn("retry_from", F.when(~F.col("ok"), "s4_write")))


_RUN = re.compile(r"[^\W_]+")


def _marked(c: Column) -> Column:
    """Text in which every run of letters and digits stands between two \\x01 and two \\x02, and white space is one blank."""
    blank = F.regexp_replace(F.translate(c, "\x01\x02", "\x03\x03"), r"\s+", " ")
    return F.regexp_replace(blank, r"[\p{L}\p{N}]+", "\x01\x01$0\x02\x02")


def _needles(term: str, mode: str) -> list[tuple[str, int]]:
    """What to look for, and whether it counts for or against the term.

    In marked text whole words are plain substrings; a needle takes one of the two marks at its ends, so
    that neighbours share none. A term that begins or ends with another sign must not touch a letter or
    digit there, so such places are taken off again.
    """
    if mode == "substring":
        return [(term, 1)]
    own = _RUN.sub("\x01\x01\\g<0>\x02\x02", " ".join(term.lower().split()))
    heads = [("", 1)] if own.startswith("\x01") else [("", 1), ("\x02", -1)]
    tails = [("", 1)] if own.endswith("\x02") else [("", 1), ("\x01", -1)]
    own = own.removeprefix("\x01").removesuffix("\x02")
    return [(h + own + t, x * y) for h, x in heads for t, y in tails]


def lexicon_hits(texts: DataFrame, lexicon: dict[str, list[str]] | None = None, key: str = "doc_id",
                 body: str = "text", mode: str = "word") -> DataFrame:
    """(key, category, term, n) for every listed term a text holds.

    The lexicon rides along as a literal array, so there is no join and no shuffle. Only terms
    whose first word (or, in substring mode, whose text) occurs at all are counted, by the length
    that the text loses with them; no pattern is compiled for a term.
    """
    terms = [(c, x) for c, listed in (lexicon or K.DRAFT_LEXICON).items() for x in listed]
    probe = (lambda x: _RUN.findall(x.lower())[0]) if mode == "word" else (lambda x: x)
    entries = F.lit([[c, x, probe(x)] for c, x in terms])
    needles = F.lit([[n for n, _ in _needles(x, mode)] for _, x in terms])
    signs = F.lit([[s for _, s in _needles(x, mode)] for _, x in terms])
    probes = F.lit(sorted({probe(x) for _, x in terms}))

    def occurring(t: Column) -> Column:
        if mode == "word":
            return F.array_intersect(probes, F.split(t, r"[^\p{L}\p{N}]+"))
        return F.filter(probes, lambda p: F.contains(t, p))

    def times(t: Column, needle: Column) -> Column:
        return ((F.length(t) - F.length(F.replace(t, needle, F.lit("")))) / F.length(needle)).cast("int")

    def count(t: Column, found: Column) -> Column:
        held = F.filter(F.sequence(F.lit(0), F.lit(len(terms) - 1)), lambda i: F.array_contains(found, entries[i][2]))
        return F.transform(held, lambda i: F.struct(
            entries[i][0].alias("category"), entries[i][1].alias("term"), F.aggregate(
                F.zip_with(needles[i], signs[i], lambda n, s: times(t, n) * s), F.lit(0), lambda a, x: a + x).alias("n")))

    counted = let(F.lower(body), lambda low: let(occurring(low), lambda found: F.when(
        F.size(found) > 0, let(_marked(low) if mode == "word" else low, lambda t: count(t, found)))))
    return (texts.select(key, F.explode(F.filter(counted, lambda h: h["n"] > 0)).alias("h"))
            .select(key, "h.*"))


def _event_columns(events: DataFrame) -> DataFrame:
    names = {"start_dt": "ev_start", "neighborhood": "ev_area", "title": "ev_title"}
    return events.select("event_id", *[F.col(c).alias(a) for c, a in names.items()])


def _misses(rules: list[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[
        F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules]))


def _states_date(c: Column, start: Column) -> Column:
    # a day number ends before another digit: August 22 does not state August 2
    days = F.concat(F.lit("(?:"), F.date_format(start, "MMMM d"), F.lit("|"), F.date_format(start, "MMM d"), F.lit(")(?:[^0-9]|$)"))
    return F.rlike(c, days)


def _metadata_rules(site_suffix: str | None) -> dict[str, Column]:
    title, desc = F.coalesce("meta_title", F.lit("")), F.coalesce("meta_description", F.lit(""))
    slug = F.coalesce("slug_stem", F.lit(""))
    tokens = F.filter(F.split(slug, "-"), lambda x: x != "")
    months = F.array(*[F.lit(m) for m in K.MONTHS])
    suffix = F.contains(title, F.lit(site_suffix.strip())) if site_suffix else F.lit(False)
    return {
        "title_length": F.length(title) > K.META_TITLE_MAX,
        "title_pipe": F.contains(title, F.lit("|")) | suffix,
        "description_length": F.length(desc) > K.META_DESCRIPTION_MAX,
        "description_date": ~_states_date(desc, F.col("ev_start")),
        "description_area": ~F.contains(desc, F.col("ev_area")),
        "slug_characters": ~F.rlike(slug, F.lit(r"^[a-z0-9-]+$")),
        "slug_date": F.arrays_overlap(tokens, months)
        | F.exists(tokens, lambda x: F.rlike(x, F.lit(r"^(?:19|20)\d{2}$"))),
        "slug_tokens": ~F.size(tokens).between(3, 7),
        "hook_length": text.word_count(F.col("hook_line")) > K.HOOK_WORDS_MAX,
        "disclaimer": ~F.col("disclaimer").eqNullSafe(F.lit(K.DISCLAIMER)),
    }


def metadata_gate(drafts: DataFrame, events: DataFrame, site_suffix: str | None = None) -> DataFrame:
    """Title, description, slug, hook and disclaimer rules; ``misses`` lists the broken ones."""
    joined = drafts.join(_event_columns(events), "event_id", "left")
    return joined.withColumn("misses", _misses(list(_metadata_rules(site_suffix).items()))).withColumn(
        "ok", F.size("misses") == 0)


def spaced(c: Column) -> Column:
    """Folded words, each with its own blank on both sides, so neighbours can be counted."""
    folded = F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.concat(F.lit(" "), F.replace(folded, F.lit(" "), F.lit("  ")), F.lit(" "))


def occurrences(spaced_text: Column, spaced_phrase: Column) -> Column:
    """How often a folded phrase occurs as whole words."""
    def count(x: Column) -> Column:
        removed = F.replace(x["t"], x["p"], F.lit(""))
        n = (F.length(x["t"]) - F.length(removed)) / F.length(x["p"])
        return F.when((F.trim(x["p"]) == "") | ~F.contains(x["t"], x["p"]), 0).otherwise(n).cast("int")

    return let(F.struct(spaced_text.alias("t"), spaced_phrase.alias("p")), count)


def seo_metrics(drafts: DataFrame, events: DataFrame) -> DataFrame:
    """Primary-phrase and neighborhood placement and density per draft.

    The primary phrase is the event title, compared on folded words.
    """
    joined = drafts.join(_event_columns(events), "event_id", "left")
    folded = joined.withColumns({
        "_p": spaced(F.col("ev_title")), "_a": spaced(F.col("ev_area")),
        "_hook": spaced(F.col("hook_line")), "_body": spaced(body_text(F.col("sections"))),
        "_keys": F.filter(F.split(F.lower(F.col("ev_title")), r"[^\p{L}\p{N}]+"), lambda w: w != ""),
    })
    base = folded.withColumn("phrase_count", occurrences(F.concat("_hook", "_body"), F.col("_p")))
    in_heading = lambda s: occurrences(spaced(s["heading"]), F.col("_p")) > 0
    share = let(F.filter(F.split("_body", " +"), lambda w: w != ""), lambda ws: F.try_divide(
        F.size(F.filter(ws, lambda w: F.array_contains(F.col("_keys"), w))), F.size(ws)))
    sentences = F.split(F.concat_ws(" ", "hook_line", body_text(F.col("sections"))), r"[.!?]+")
    return base.withColumns({
        "keyword_share": F.round(share, 6),
        "headings_with_phrase": F.size(F.filter("sections", in_heading)),
        "area_count": occurrences(F.col("_body"), F.col("_a")),
        "twice_in_sentence": F.when(F.col("phrase_count") < 2, F.lit(False)).otherwise(F.exists(
            sentences, lambda s: occurrences(spaced(s), F.col("_p")) >= 2)),
        "phrase_in_title": occurrences(
            spaced(F.substring("meta_title", 1, 40)), F.col("_p")) > 0,
        "phrase_in_description": occurrences(
            spaced(F.col("meta_description")), F.col("_p")) > 0,
        "phrase_in_hook": occurrences(F.col("_hook"), F.col("_p")) > 0,
    }).drop("_p", "_a", "_hook", "_body", "_keys")


def parse_links(drafts: DataFrame) -> DataFrame:
    """(draft_id, anchor, slug, in_body) per suggested link, read next to the draft's text."""
    body = body_text(F.col("sections"))
    rows = drafts.select("draft_id", F.explode(F.transform(F.col("links"), lambda x: F.struct(
        F.regexp_extract(x, r'^\s*"(.*)"\s*->\s*(\S+)\s*$', 1).alias("anchor"),
        F.regexp_extract(x, r'^\s*"(.*)"\s*->\s*(\S+)\s*$', 2).alias("slug"),
        F.contains(body, F.regexp_extract(x, r'^\s*"(.*)"\s*->\s*(\S+)\s*$', 1)).alias("in_body"),
    ))).alias("l"))
    return rows.select("draft_id", "l.*")


def audit_links(drafts: DataFrame, posts: DataFrame) -> DataFrame:
    """Per draft with links: count, invented targets, repeated targets, weak or absent anchors."""
    known = posts.select("slug").distinct().withColumn("_known", F.lit(True))
    weak = F.lower("anchor").isin("", *K.WEAK_ANCHORS) | (F.col("anchor") == F.col("slug"))
    per = parse_links(drafts).join(known, "slug", "left").groupBy("draft_id").agg(
        F.count("*").alias("n_links"),
        F.count_if(F.col("_known").isNull()).alias("invented_targets"),
        (F.count("*") - F.countDistinct("slug")).alias("repeated_targets"),
        F.count_if(weak | ~F.col("in_body")).alias("bad_anchors"))
    return per.withColumn("ok", (F.col("n_links") <= 2) & (F.col("invented_targets") == 0)
                          & (F.col("repeated_targets") == 0) & (F.col("bad_anchors") == 0))


def seo_score_cap(drafts: DataFrame, events: DataFrame, posts: DataFrame,
                  site_suffix: str | None = None) -> DataFrame:
    """Highest score the written rules allow: 4 after a hard miss, 7 after a real defect, else 10."""
    measured = seo_metrics(drafts, events)
    meta = {k: v for k, v in _metadata_rules(site_suffix).items()
            if k not in ("slug_tokens", "hook_length", "disclaimer")}
    links = audit_links(drafts, posts).select(
        "draft_id", "invented_targets", "repeated_targets", "bad_anchors")
    joined = measured.join(links, "draft_id", "left")
    n = F.coalesce(F.size("sections"), F.lit(0))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    heads = F.transform("sections", lambda s: F.coalesce(F.lower(s["heading"]), F.lit("")))
    hard = [*meta.items(),
            ("section_count", ~n.between(K.SECTIONS_MIN, K.SECTIONS_MAX)),
            ("list_or_subheading", F.exists("sections", lambda s: F.rlike(
                F.coalesce(s["body"], F.lit("")), F.lit(r"(?m)^\s*(?:#{1,6}\s|[-*•]\s|\d+[.)]\s|\*\*[^*]+\*\*\s*$)")))),
            ("invented_link", zero("invented_targets")),
            ("phrase_missing", ~F.col("phrase_in_title") | ~F.col("phrase_in_hook"))]
    defects = [("phrase_in_no_heading", F.col("headings_with_phrase") == 0),
               ("area_too_rare", F.col("area_count") < 2),
               ("stuffing", ~F.col("phrase_count").between(2, 5) | (F.col("keyword_share") > 0.02)
                | (F.col("headings_with_phrase") >= 3) | F.col("twice_in_sentence")),
               ("headings", (F.size(F.array_distinct(heads)) < n) | F.exists(
                   "sections", lambda s: (F.length(s["heading"]) > 60) | F.endswith(s["heading"], F.lit("?")))),
               ("links", zero("repeated_targets") | zero("bad_anchors")),
               ("line_break", F.exists("sections", lambda s: F.contains(s["body"], F.lit("\n"))))]
    scored = joined.withColumn("hard_misses", _misses(hard)).withColumn("defects", _misses(defects))
    cap = F.when(F.size("hard_misses") > 0, 4).when(F.size("defects") > 0, 7).otherwise(10)
    return scored.withColumn("score_cap", cap).select(
        "draft_id", "score_cap", "hard_misses", "defects")


def judge_panel(verdicts: DataFrame, drafts: DataFrame, dimensions: list[str] = K.JUDGE_DIMENSIONS,
                threshold: int = K.JUDGE_PASS) -> DataFrame:
    """Outcome per draft: pass, fail (back to writing) or incomplete (a judge is missing).

    Every draft gets a row; one that nobody judged misses all dimensions.
    """
    wanted = F.array(*[F.lit(d) for d in dimensions])
    mine = verdicts.filter(F.col("dimension").isin(*dimensions))
    per = mine.groupBy("draft_id").agg(
        F.collect_set("dimension").alias("_have"),
        F.sort_array(F.collect_set(F.when(F.col("score") < threshold, F.col("dimension")))).alias("failed"),
        F.min("score").alias("lowest"))
    none = F.array().cast("array<string>")
    per = drafts.select("draft_id").distinct().join(per, "draft_id", "left").withColumns({
        "_have": F.coalesce("_have", none), "failed": F.coalesce("failed", none)})
    missing = F.array_except(wanted, F.col("_have"))
    outcome = F.when(F.size(missing) > 0, "incomplete").when(F.size("failed") > 0, "fail").otherwise("pass")
    return (per.withColumn("missing", missing).withColumn("outcome", outcome)
            .withColumn("retry_from", F.when(outcome == "fail", "s4_write")).drop("_have"))


def audit_evidence(verdicts: DataFrame, drafts: DataFrame) -> DataFrame:
    """Per verdict: below 10 needs evidence, a 10 has none, and every excerpt is verbatim.

    ``verdicts`` (draft_id, dimension, score, evidence ARRAY<STRUCT<claim, excerpt>>). Draft
    texts meet verdicts once per draft, and only the findings leave the join.
    """
    fields = F.concat(
        F.array("hook_line", "meta_title", "meta_description", "slug_stem", "disclaimer"),
        bodies(F.col("sections")), F.transform("sections", lambda s: s["heading"]))
    texts = drafts.select("draft_id", F.array_compact(fields).alias("_texts"))
    rows = verdicts.join(texts, "draft_id", "left")
    said = lambda e: F.exists(F.col("_texts"), lambda x: F.contains(x, e["excerpt"]))
    n = F.coalesce(F.size("evidence"), F.lit(0))
    verbatim = (n == 0) | F.coalesce(F.forall("evidence", lambda e: F.coalesce(said(e), F.lit(False))),
                                     F.lit(False))
    return rows.select(
        "draft_id", "dimension", "score", n.alias("n_evidence"), verbatim.alias("verbatim"),
        F.when(F.col("score") >= 10, n == 0).otherwise((n > 0) & verbatim).alias("ok"))


def factcheck_audit(loops: DataFrame, changelog: DataFrame, drafts: DataFrame,
                    max_loops: int = K.MAX_ATTEMPTS) -> DataFrame:
    """Per draft: is the change log sound, and where does the draft go.

    ``loops`` (draft_id, loop), ``changelog`` (draft_id, loop, original, action, reason). A loop
    is clean when it logged nothing; an out-of-scope entry sends the draft back to writing.
    """
    texts = drafts.select("draft_id", F.concat(
        F.array(F.coalesce("hook_line", F.lit("")), F.coalesce("disclaimer", F.lit("")),
                F.coalesce("meta_title", F.lit("")), F.coalesce("meta_description", F.lit("")),
                F.coalesce("slug_stem", F.lit(""))),
        bodies(F.col("sections")),
        F.transform("sections", lambda s: F.coalesce(s["heading"], F.lit("")))).alias("_texts"))
    checked = changelog.join(texts, "draft_id", "left").select(
        "draft_id", "loop", "action", "reason",
        F.coalesce(F.exists("_texts", lambda x: F.contains(x, F.col("original"))), F.lit(False)).alias("verbatim"))
    per_loop = checked.groupBy("draft_id", "loop").agg(
        F.count("*").alias("n"), F.bool_and("verbatim").alias("verbatim"),
        F.bool_and(F.col("action").isin("removed", "corrected")).alias("actions_ok"),
        F.bool_or(F.startswith("reason", F.lit("OUT OF SCOPE"))).alias("out_of_scope"))
    joined = loops.join(per_loop, ["draft_id", "loop"], "left")
    last = F.max(F.struct("loop", (F.col("n").isNull()).alias("clean"),
                          F.coalesce("out_of_scope", F.lit(False)).alias("oos")))
    per = joined.groupBy("draft_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_changes"),
        F.coalesce(F.bool_and("verbatim"), F.lit(True)).alias("all_verbatim"),
        F.coalesce(F.bool_and("actions_ok"), F.lit(True)).alias("actions_ok"), last.alias("_last"))
    route = (F.when(F.col("_last.clean"), "next").when(F.col("_last.oos"), "s4_write")
             .when(F.col("_last.loop") >= max_loops, "hold").otherwise("again"))
    return per.withColumn("clean", F.col("_last.clean")).withColumn("route", route).drop("_last")


_NUMBER = r"\d+(?:[.,:]\d+)*"


def untraceable_numbers(drafts: DataFrame, facts: DataFrame) -> DataFrame:
    """Numbers in a draft's text that no event or transit field states.

    ``facts`` (event_id, fact_text): the event's fields and stops as one text.
    """
    shown = F.regexp_extract_all(
        F.concat_ws(" ", "hook_line", body_text(F.col("sections"))), F.lit(_NUMBER), 0)
    used = drafts.select("draft_id", "event_id", F.array_distinct(shown).alias("_used"))
    known = facts.select("event_id", F.regexp_extract_all("fact_text", F.lit(_NUMBER), 0).alias("_known"))
    return used.join(known, "event_id", "left").select("draft_id", F.array_sort(F.array_except(
        "_used", F.coalesce("_known", F.array().cast("array<string>")))).alias("numbers"))


def revision_notes(verdicts: DataFrame, threshold: int = K.JUDGE_PASS) -> DataFrame:
    """Notes of failing verdicts as "[dimension] note" rows.

    ``verdicts`` (draft_id, dimension, score, revision_notes ARRAY<STRING>).
    """
    return (verdicts.filter(F.col("score") < threshold)
            .select("draft_id", "dimension", F.explode("revision_notes").alias("note"))
            .select("draft_id", F.concat(F.lit("["), "dimension", F.lit("] "), "note").alias("note")))


def editor_route(drafts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Apply an editor's decision: PASS lays adjustments over the draft, else hold with reason.

    ``decisions`` (draft_id, verdict, reason, hook_line, meta_title, meta_description); a null or
    empty adjustment changes nothing.
    """
    fields = ["hook_line", "meta_title", "meta_description"]
    d = drafts.select("draft_id", F.struct(*fields).alias("draft"))
    e = decisions.select("draft_id", "verdict", "reason", F.struct(*fields).alias("adjust"))
    joined = d.join(e, "draft_id", "left")
    passed = F.coalesce(F.col("verdict") == "PASS", F.lit(False))
    laid = structs.overlay(F.col("draft"), F.col("adjust"), fields)
    out = F.when(passed, laid).otherwise(F.col("draft"))
    return joined.select(
        "draft_id", *[out[f].alias(f) for f in fields],
        F.when(passed, "next").when(F.col("verdict").isNull(), "waiting").otherwise("hold").alias("route"),
        F.when(~passed & F.col("verdict").isNotNull(), F.concat(
            F.lit("held by editor: "), F.coalesce("reason", F.lit("no reason given")))).alias("hold_reason"))


def review_history(articles: DataFrame, panel: DataFrame, facts: DataFrame) -> DataFrame:
    """What an editor sees beside a draft: panel outcome, fact-check route, attempts, re-holds."""
    return (articles.join(panel.select("draft_id", "outcome", "failed", "lowest"), "draft_id", "left")
            .join(facts.select("draft_id", "n_changes", "clean"), "draft_id", "left"))
