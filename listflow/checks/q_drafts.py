"""Checked queries: text gates, judge panels and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from listflow import constants as K
from listflow.checks.registry import register
from listflow.checks.sqlparts import _WS, collapse, q
from listflow.functions import structs, text
from listflow.operators import documents, gates

D = ("drafts",)
DE = ("drafts", "draft_events")

_SECTIONS = r"""list_transform(list_filter(string_split(body, chr(10)), lambda x: trim(x) <> ''), lambda x: {'heading': regexp_extract(x, '^\S+( \S+)?'), 'body': x})"""
FD = f"""fd as (select *, draft_id as event_id, {_SECTIONS} as sections, case when draft_id % 11 = 0 then 'Other' else {q(K.DISCLAIMER)} end as disclaimer,
  ['"' || substr(body, 4, 9) || '" -> slug-art_' || cast(draft_id * 5 + 4 as varchar)] || case when draft_id % 4 = 0 then ['"read more" -> slug-art_' || cast(draft_id * 5 + 4 as varchar)] else [] end as links from drafts)"""


def full_drafts(t):
    """Drafts with the nested columns the gates read: one section per line of the body."""
    return t.drafts.withColumns({
        "event_id": F.col("draft_id"),
        "sections": F.expr(r"""transform(filter(split(body, '\n'), x -> trim(x) <> ''),
            x -> named_struct('heading', regexp_extract(x, '^\\S+( \\S+)?', 0), 'body', x))"""),
        "disclaimer": F.when(F.col("draft_id") % 11 == 0, "Other").otherwise(K.DISCLAIMER),
        "links": F.expr("""concat(array(concat('"', substr(body, 4, 9), '" -> slug-art_', draft_id * 5 + 4)),
            if(draft_id % 4 = 0, array(concat('"read more" -> slug-art_', draft_id * 5 + 4)), cast(array() as array<string>)))"""),
    })


_BODY = "array_to_string(list_transform(sections, lambda s: s.body), ' ')"
_NWORDS = "len(list_filter(string_split({}, ' '), lambda w: w <> ''))"


@register("g1_draft_gate", f"""
with {FD}, c as (select draft_id, len(sections) as n_sections, {_NWORDS.format(collapse(_BODY))} as n_words, {_BODY} as b, hook_line from fd)
select draft_id, n_sections, n_words, case when n_sections not between 5 and 6 then n_sections || ' sections, expected 5-6'
  when n_words not between 800 and 1155 then n_words || ' words of prose, expected 800-1155' when contains(b, '—') or contains(hook_line, '—') then 'em-dash present' end as reason from c""", D)
def g1_draft_gate(t):
    return gates.draft_gate(full_drafts(t)).select(
        "draft_id", F.col("n_sections").cast("bigint").alias("n_sections"),
        F.col("n_words").cast("bigint").alias("n_words"), "reason")


@register("g1_draft_gate_strict", f"""
with {FD}, c as (select draft_id, len(sections) as n_sections, {_NWORDS.format(collapse(f"hook_line || ' ' || {_BODY} || ' ' || disclaimer"))} as n_words, {_BODY} as b, hook_line from fd)
select draft_id, n_words, n_sections between 5 and 6 and n_words between 880 and 1120 and not contains(b, '—') and not contains(hook_line, '—') as ok from c""", D)
def g1_draft_gate_strict(t):
    return gates.draft_gate(full_drafts(t), "strict").select(
        "draft_id", F.col("n_words").cast("bigint").alias("n_words"), "ok")


_TERMS = "[" + ", ".join(f"{{'category': {q(c)}, 'term': {q(x)}}}" for c, ts in K.DRAFT_LEXICON.items() for x in ts) + "]"


@register("g2_lexicon_hits", rf"""
with p as (select draft_id as doc_id, ' ' || replace(trim(regexp_replace(regexp_replace(lower(body), '([^\p{{L}}\p{{N}}\s!-])', ' \1 ', 'g'), '\s+', ' ', 'g')), ' ', '  ') || ' ' as t from drafts),
x as (select doc_id, t, unnest({_TERMS}) as e from p),
n as (select doc_id, e.category as category, e.term as term, ' ' || replace(e.term, ' ', '  ') || ' ' as needle, t from x where contains(t, ' ' || replace(e.term, ' ', '  ') || ' '))
select doc_id, category, term, cast((length(t) - length(replace(t, needle, ''))) / length(needle) as int) as n from n""", D)
def g2_lexicon_hits(t):
    return gates.lexicon_hits(t.drafts.select(F.col("draft_id").alias("doc_id"), F.col("body").alias("text")))


@register("g2_lexicon_hits_substring", f"""
with x as (select doc_id, lower(text) as t, unnest({"[" + ", ".join(q(x) for x in K.KEYWORDS["fitness"]) + "]"}) as term from documents)
select doc_id, 'fitness' as category, term, cast((length(t) - length(replace(t, term, ''))) / length(term) as int) as n from x where contains(t, term)""")
def g2_lexicon_hits_substring(t):
    return gates.lexicon_hits(t.documents, {"fitness": K.KEYWORDS["fitness"]}, mode="substring")


_MONTHS = "[" + ", ".join(q(m) for m in K.MONTHS) + "]"
_SLUG = "list_filter(string_split(slug_stem, '-'), lambda x: x <> '')"
_META = {
    "title_length": "length(meta_title) > 60",
    "title_pipe": "contains(meta_title, '|')",
    "description_length": "length(meta_description) > 155",
    "description_date": "not regexp_matches(meta_description, '(August|Aug) 22([^0-9]|$)')",
    "description_area": "not contains(meta_description, neighborhood)",
    "slug_characters": "not regexp_matches(slug_stem, '^[a-z0-9-]+$')",
    "slug_date": rf"list_has_any({_SLUG}, {_MONTHS}) or len(list_filter({_SLUG}, lambda x: regexp_matches(x, '^(19|20)\d\d$'))) > 0",
    "slug_tokens": f"len({_SLUG}) not between 3 and 7",
    "hook_length": f"{_NWORDS.format(collapse('hook_line'))} > 30",
    "disclaimer": f"disclaimer <> {q(K.DISCLAIMER)}",
}


def _list_of(rules):
    return "array_to_string(list_filter([" + ", ".join(f"case when {c} then {q(n)} end" for n, c in rules.items()) + "], lambda x: x is not null), ',')"


@register("g3_metadata_gate", f"with {FD} select draft_id, {_list_of(_META)} as misses from fd join draft_events using (event_id)", DE)
def g3_metadata_gate(t):
    return gates.metadata_gate(full_drafts(t), t.draft_events).select(
        "draft_id", F.array_join("misses", ",").alias("misses"))


def _spaced(c):
    return rf"(' ' || replace(trim(regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ', '  ') || ' ')"


def _occ(t, p):
    return f"case when trim({p}) = '' then 0 else cast((length({t}) - length(replace({t}, {p}, ''))) / length({p}) as int) end"


_SEO = rf"""j as (select fd.*, neighborhood, title, {_spaced('title')} as p, {_spaced('neighborhood')} as a, {_spaced(f"hook_line || ' ' || {_BODY}")} as prose, {_spaced(_BODY)} as bt,
  hook_line || ' ' || {_BODY} as raw, list_filter(regexp_split_to_array(lower(title), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') as keys from fd join draft_events using (event_id)),
m as (select *, {_occ('prose', 'p')} as phrase_count, round(len(list_filter(regexp_split_to_array(bt, ' +'), lambda w: w <> '' and list_contains(keys, w))) / len(list_filter(regexp_split_to_array(bt, ' +'), lambda w: w <> ''))::double, 6) as keyword_share,
  cast(len(list_filter(sections, lambda s: {_occ(_spaced('s.heading'), 'p')} > 0)) as int) as headings_with_phrase, {_occ('bt', 'a')} as area_count,
  len(list_filter(regexp_split_to_array(raw, '[.!?]+'), lambda s: {_occ(_spaced('s'), 'p')} >= 2)) > 0 as twice_in_sentence,
  {_occ(_spaced('substr(meta_title, 1, 40)'), 'p')} > 0 as phrase_in_title, {_occ(_spaced('meta_description'), 'p')} > 0 as phrase_in_description, {_occ(_spaced('hook_line'), 'p')} > 0 as phrase_in_hook from j)"""
_SEO_COLS = "draft_id, phrase_count, keyword_share, headings_with_phrase, area_count, twice_in_sentence, phrase_in_title, phrase_in_description, phrase_in_hook"


@register("a9_seo_metrics", f"with {FD}, {_SEO} select {_SEO_COLS} from m", DE)
def a9_seo_metrics(t):
    return gates.seo_metrics(full_drafts(t), t.draft_events).select(*_SEO_COLS.split(", "))


_LINKS = r"""lk as (select draft_id, regexp_extract(l, '^\s*"(.*)"\s*->\s*(\S+)\s*$', 1, 's') as anchor, regexp_extract(l, '^\s*"(.*)"\s*->\s*(\S+)\s*$', 2, 's') as slug, """ + _BODY + """ as b
  from (select *, unnest(links) as l from fd)),
la as (select draft_id, count(*) as n_links, count(*) filter (slug not in (select slug from published)) as invented_targets, count(*) - count(distinct slug) as repeated_targets,
  count(*) filter (lower(anchor) in ('', 'read more', 'click here', 'this article') or anchor = slug or not contains(b, anchor)) as bad_anchors from lk group by draft_id)"""


def no_line_links(t):
    """Drafts whose link anchors are single-line, as the link format requires."""
    return full_drafts(t).withColumn("links", F.transform("links", lambda x: F.replace(x, F.lit("\n"), F.lit(" "))))


_FDL = FD.replace("substr(body, 4, 9)", "replace(substr(body, 4, 9), chr(10), ' ')")


@register("j15_audit_links", f"with {_FDL}, {_LINKS} select draft_id, n_links, invented_targets, repeated_targets, bad_anchors, n_links <= 2 and invented_targets = 0 and repeated_targets = 0 and bad_anchors = 0 as ok from la", ("drafts", "published"))
def j15_audit_links(t):
    return gates.audit_links(no_line_links(t), t.published)


_HARD = {**{k: v for k, v in _META.items() if k not in ("slug_tokens", "hook_length", "disclaimer")},
         "section_count": "len(sections) not between 5 and 6",
         "list_or_subheading": r"len(list_filter(sections, lambda s: regexp_matches(s.body, '(?m)^\s*(?:#{1,6}\s|[-*•]\s|\d+[.)]\s|\*\*[^*]+\*\*\s*$)'))) > 0",
         "invented_link": "coalesce(invented_targets, 0) > 0",
         "phrase_missing": "not phrase_in_title or not phrase_in_hook"}
_DEFECTS = {"phrase_in_no_heading": "headings_with_phrase = 0", "area_too_rare": "area_count < 2",
            "stuffing": "phrase_count not between 2 and 5 or keyword_share > 0.02 or headings_with_phrase >= 3 or twice_in_sentence",
            "headings": "len(list_distinct(list_transform(sections, lambda s: lower(s.heading)))) < len(sections) or len(list_filter(sections, lambda s: length(s.heading) > 60 or s.heading like '%?')) > 0",
            "links": "coalesce(repeated_targets, 0) > 0 or coalesce(bad_anchors, 0) > 0",
            "line_break": "len(list_filter(sections, lambda s: contains(s.body, chr(10)))) > 0"}


@register("g4_seo_score_cap", f"""
with {_FDL}, {_SEO}, {_LINKS}, z as (select m.draft_id, {_list_of(_HARD)} as hard_misses, {_list_of(_DEFECTS)} as defects from m left join la on la.draft_id = m.draft_id)
select draft_id, hard_misses, defects, case when hard_misses <> '' then 4 when defects <> '' then 7 else 10 end as score_cap from z""", DE + ("published",))
def g4_seo_score_cap(t):
    return gates.seo_score_cap(no_line_links(t), t.draft_events, t.published).select(
        "draft_id", F.array_join("hard_misses", ",").alias("hard_misses"),
        F.array_join("defects", ",").alias("defects"), "score_cap")


_DIMS = "[" + ", ".join(q(d) for d in K.JUDGE_DIMENSIONS) + "]"


@register("a6_judge_panel", f"""
with p as (select draft_id, list(distinct dimension) as have, coalesce(array_to_string(list_sort(list(distinct dimension) filter (score < 8)), ','), '') as failed, min(score) as lowest from verdicts where draft_id % 17 <> 4 group by draft_id)
select draft_id, coalesce(failed, '') as failed, lowest, array_to_string(list_filter({_DIMS}, lambda d: not list_contains(coalesce(have, []), d)), ',') as missing,
  case when len(list_filter({_DIMS}, lambda d: not list_contains(coalesce(have, []), d))) > 0 then 'incomplete' when failed <> '' then 'fail' else 'pass' end as outcome from (select distinct draft_id from drafts) left join p using (draft_id)""", ("verdicts", "drafts"))
def a6_judge_panel(t):
    return gates.judge_panel(t.verdicts.filter("draft_id % 17 <> 4"), t.drafts).select(
        "draft_id", F.array_join("failed", ",").alias("failed"), "lowest",
        F.array_join("missing", ",").alias("missing"), "outcome")


def verdict_rows(t):
    return t.verdicts.select(
        "draft_id", "dimension", "score",
        F.when(F.col("draft_id") % 13 == 0, F.array().cast("array<struct<claim:string,excerpt:string>>"))
        .otherwise(F.array(F.struct(F.lit("claim").alias("claim"), "excerpt"))).alias("evidence"),
        F.array(F.concat(F.lit("fix "), "dimension"), F.lit("tighten")).alias("revision_notes"))


@register("j14_audit_evidence", f"""
with {FD}, j as (select v.*, case when v.draft_id % 13 = 0 then 0 else 1 end as n_evidence,
  contains(hook_line, excerpt) or contains(meta_title, excerpt) or contains(meta_description, excerpt) or contains(slug_stem, excerpt) or contains(disclaimer, excerpt)
  or len(list_filter(sections, lambda s: contains(s.body, v.excerpt) or contains(s.heading, v.excerpt))) > 0 as said from verdicts v join fd using (draft_id))
select draft_id, dimension, score, n_evidence, n_evidence = 0 or said as verbatim, case when score >= 10 then n_evidence = 0 else n_evidence > 0 and said end as ok from j""", ("drafts", "verdicts"))
def j14_audit_evidence(t):
    return gates.audit_evidence(verdict_rows(t), full_drafts(t))


def loops_and_log(t):
    loops = t.drafts.select("draft_id", F.explode(F.expr("sequence(1, cast(1 + draft_id % 3 as int))")).alias("loop"))
    log = loops.join(t.drafts.select("draft_id", "body"), "draft_id").filter("(draft_id + loop) % 4 <> 0").selectExpr(
        "draft_id", "loop", "if(draft_id % 9 = 0, 'never said', substr(hook, 2, 8)) as original".replace("hook", "body"),
        "if(draft_id % 14 = 0, 'rephrased', if(loop % 2 = 0, 'removed', 'corrected')) as action",
        "if(draft_id % 10 = 0, 'OUT OF SCOPE (meta_title): wrong', 'not in the facts') as reason")
    return loops, log.withColumn("original", F.regexp_replace("original", r"\n.*", ""))


@register("g5_factcheck_audit", rf"""
with {FD}, lp as (select draft_id, unnest(range(1, 2 + draft_id % 3)) as loop from drafts),
lg as (select draft_id, loop, regexp_replace(case when draft_id % 9 = 0 then 'never said' else substr(body, 2, 8) end, '\n.*', '', 'g') as original,
  case when draft_id % 14 = 0 then 'rephrased' else 'removed' end as action, draft_id % 10 = 0 as oos from lp join drafts using (draft_id) where (draft_id + loop) % 4 <> 0),
ck as (select lg.*, contains(hook_line, original) or contains(disclaimer, original) or contains(meta_title, original) or contains(meta_description, original) or contains(slug_stem, original)
  or len(list_filter(sections, lambda s: contains(s.body, lg.original) or contains(s.heading, lg.original))) > 0 as verbatim from lg join fd using (draft_id)),
pl as (select draft_id, loop, count(*) as n, bool_and(verbatim) as verbatim, bool_and(action <> 'rephrased') as actions_ok, bool_or(oos) as oos from ck group by all),
pd as (select draft_id, coalesce(cast(sum(n) as bigint), 0) as n_changes, coalesce(bool_and(verbatim), true) as all_verbatim, coalesce(bool_and(actions_ok), true) as actions_ok,
  arg_max(n is null, loop) as clean, arg_max(coalesce(oos, false), loop) as oos, max(loop) as loops from lp left join pl using (draft_id, loop) group by draft_id)
select draft_id, n_changes, all_verbatim, actions_ok, clean, case when clean then 'next' when oos then 's4_write' when loops >= 3 then 'hold' else 'again' end as route from pd""", D)
def g5_factcheck_audit(t):
    loops, log = loops_and_log(t)
    return gates.factcheck_audit(loops, log, full_drafts(t))


@register("g6_untraceable_numbers", rf"""
with {FD}, u as (select draft_id, event_id, list_distinct(regexp_extract_all(hook_line || ' ' || {_BODY}, '\d+(?:[.,:]\d+)*')) as used from fd),
k as (select event_id, regexp_extract_all(cast(event_id as varchar) || ' ' || coalesce(price, '') || ' 1 2 3 10 2024', '\d+(?:[.,:]\d+)*') as known from draft_events)
select draft_id, array_to_string(list_sort(list_filter(used, lambda x: not list_contains(known, x))), ' ') as numbers from u join k using (event_id)""", DE)
def g6_untraceable_numbers(t):
    facts = t.draft_events.select("event_id", F.concat_ws(
        " ", F.col("event_id").cast("string"), F.coalesce("price", F.lit("")), F.lit("1 2 3 10 2024")).alias("fact_text"))
    return gates.untraceable_numbers(full_drafts(t), facts).select("draft_id", F.array_join("numbers", " ").alias("numbers"))


@register("g7_revision_notes", """
select draft_id, '[' || dimension || '] ' || unnest(['fix ' || dimension, 'tighten']) as note from verdicts where score < 8""", ("verdicts",))
def g7_revision_notes(t):
    return gates.revision_notes(verdict_rows(t))


_DECIDED = """select draft_id, case when draft_id % 3 = 0 then 'PASS' else 'HOLD' end as verdict, case when draft_id % 5 <> 0 then 'thin' end as reason,
  case when draft_id % 6 = 0 then 'New hook' when draft_id % 6 = 3 then '' end as hook_line, cast(null as string) as meta_title, 'Better description' as meta_description from drafts where draft_id % 17 <> 0"""


@register("g8_eic_route", f"""
with e as ({_DECIDED})
select d.draft_id, case when verdict = 'PASS' and e.hook_line <> '' then e.hook_line else d.hook_line end as hook_line, d.meta_title,
  case when verdict = 'PASS' then e.meta_description else d.meta_description end as meta_description,
  case when verdict = 'PASS' then 'next' when verdict is null then 'waiting' else 'hold' end as route,
  case when verdict <> 'PASS' then 'held by editor: ' || coalesce(reason, 'no reason given') end as hold_reason from drafts d left join e using (draft_id)""", D)
def g8_eic_route(t):
    t.drafts
    return gates.editor_route(full_drafts(t), t.spark.sql(_DECIDED))


@register("g8_review_history", f"""
with p as (select draft_id, count(distinct dimension) as nd, count(*) filter (score < 8) as nf, min(score) as lowest from verdicts group by draft_id)
select draft_id, cast(draft_id % 4 as int) as reholds, case when nd < 7 then 'incomplete' when nf > 0 then 'fail' else 'pass' end as outcome, lowest,
 cast((select count(*) from range(1, 2 + draft_id % 3) r(l) where (draft_id + l) % 4 <> 0) as bigint) as n_changes from drafts left join p using (draft_id)""", ("drafts", "verdicts"))
def g8_review_history(t):
    loops, log = loops_and_log(t)
    audit = gates.factcheck_audit(loops, log, full_drafts(t))
    articles = t.drafts.selectExpr("draft_id", "cast(draft_id % 4 as int) as reholds")
    return gates.review_history(articles, gates.judge_panel(t.verdicts, t.drafts), audit).select(
        "draft_id", "reholds", "outcome", "lowest", "n_changes")


@register("f25_overlay_fields", "select draft_id, case when draft_id % 2 = 0 then 'X' || draft_id else hook_line end as hook_line, meta_title from drafts", D)
def f25_overlay_fields(t):
    d = t.drafts.select("draft_id", F.struct("hook_line", "meta_title").alias("draft"), F.struct(
        F.expr("if(draft_id % 2 = 0, concat('X', draft_id), '')").alias("hook_line"),
        F.lit(None).cast("string").alias("meta_title")).alias("revised"))
    return d.select("draft_id", structs.overlay(F.col("draft"), F.col("revised"), ["hook_line", "meta_title"]).alias("o")).select("draft_id", "o.*")


_PAYLOAD_JSON = "case kind when 'bad' then null else '{\"score\":' || cast(cast((response_id // 100) % 10 as bigint) as varchar) || '}' end"


@register("f22_extract_json_payload", f"select response_id, {_PAYLOAD_JSON} as payload, case kind when 'bad' then null else cast((response_id // 100) % 10 as int) end as score from responses", ("responses",))
def f22_extract_json_payload(t):
    v = structs.extract_json_payload(F.col("payload"))
    return t.responses.select("response_id", F.to_json(v).alias("payload"),
                              F.try_variant_get(v, "$.score", "int").alias("score"))


@register("f23_jsonable", """
select doc_id, '{"lang":' || coalesce('"' || lang || '"', 'null') || ',"counts":[' || n_chars || ',null],"source":{"name":"' || source || '"}}' as raw from documents""")
def f23_jsonable(t):
    nested = F.struct("lang", F.array("n_chars", F.lit(None).cast("bigint")).alias("counts"),
                      F.struct(F.col("source").alias("name")).alias("source"))
    return t.documents.select("doc_id", structs.jsonable(nested).alias("raw"))


# --- documents ----------------------------------------------------------------------------


def articles(t):
    stop = F.struct(F.lit("Pine & 3rd").alias("stop_name"), F.array(F.lit("7"), F.lit("49"), F.lit("A Line"), F.lit("Z")).alias("routes"),
                    F.col("event_id").cast("int").alias("distance_m"))
    ev = t.draft_events.withColumn("transit", F.when(F.col("event_id") % 2 == 1, F.array(stop)))
    boxed = documents.details_box(ev).withColumn(
        "image_url", F.expr("if(event_id % 3 = 0, concat('https://img.example/', event_id, '.jpg'), null)"))
    return full_drafts(t).join(boxed.select("event_id", "details", "image_url", F.lit("Alt.").alias("image_alt")), "event_id")


_BOX = """list_filter([{'l': 'When', 'v': 'Saturday, August 22, 9:00 AM'}, {'l': 'Where', 'v': venue_name || coalesce(', ' || venue_address, '')}, {'l': 'Cost', 'v': price},
  {'l': 'Register', 'v': trim(register_url)}, {'l': 'Getting there', 'v': case when event_id % 2 = 1 then 'Pine & 3rd (7, 49, A Line), ' || event_id || 'm away' end}], lambda x: x.v is not null and x.v <> '')"""


@register("f20_details_box", f"select event_id, array_to_string(list_transform({_BOX}, lambda x: x.l || ': ' || x.v), ' / ') as box from draft_events", ("draft_events",))
def f20_details_box(t):
    return articles(t).select("event_id", F.array_join(F.transform(
        "details", lambda d: F.concat(d["label"], F.lit(": "), d["value"])), " / ").alias("box"))


def _strip(c):
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


_NL = "chr(10)"
_DOC = f"""doc as (select draft_id, hook_line, sections, disclaimer, {_BOX} as box, event_id % 3 = 0 as pic from fd join draft_events using (event_id)),
dt as (select draft_id, hook_line, pic, sections, box, case when {_strip('hook_line')} <> '' then {_NL} || {_strip('hook_line')} || {_NL} else '' end || array_to_string(list_transform(box, lambda x: {_NL} || x.l || ': ' || x.v || {_NL}), '')
  || case when pic then {_NL} else '' end || array_to_string(list_transform(sections, lambda s: trim(s.heading) || {_NL} || {_strip('s.body')} || {_NL}), '') || {_NL} || disclaimer || {_NL} as plain from doc)"""


@register("r1_build_document", f"""
with {FD}, {_DOC} select draft_id, case when {_strip('hook_line')} <> '' then 1 else 0 end + len(box) + case when pic then 2 else 0 end + 2 * len(sections) + 1 as n_nodes, len(sections) as n_headings,
  case when pic then 1 else 0 end::bigint as n_images, sha256(plain) as text_hash from dt""", DE)
def r1_build_document(t):
    doc = documents.build_document(articles(t))
    n = lambda kind: F.size(F.filter("nodes", lambda x: x["type"] == kind)).cast("bigint")
    return doc.select("draft_id", F.size("nodes").cast("bigint").alias("n_nodes"), n("HEADING").alias("n_headings"),
                      n("IMAGE").alias("n_images"), F.sha2(documents.extract_text(F.col("nodes")), 256).alias("text_hash"))


@register("r2_extract_text", f"with {FD}, {_DOC} select draft_id, length(plain) as n_chars, plain from dt", DE)
def r2_extract_text(t):
    plain = documents.extract_text(F.col("nodes"))
    return documents.build_document(articles(t)).select("draft_id", F.length(plain).cast("bigint").alias("n_chars"), plain.alias("plain"))


@register("r3_prepend_banner", f"""
with {FD}, {_DOC} select draft_id, {_NL} || 'This event has ended.' || {_NL} || plain as opening, 1::bigint as n_banners from dt""", DE)
def r3_prepend_banner(t):
    doc = documents.build_document(articles(t))
    once = documents.prepend_banner(F.col("nodes"), F.lit(K.BANNERS["ended"]))
    twice = documents.prepend_banner(F.col("once"), F.lit(K.BANNERS["ended"]))
    plain = documents.extract_text(F.col("twice"))
    return doc.withColumn("once", once).withColumn("twice", twice).select(
        "draft_id", plain.alias("opening"),
        F.regexp_count(plain, F.lit(K.BANNERS["ended"])).cast("bigint").alias("n_banners"))


@register("r4_body_matches", f"""
select draft_id, contains({collapse('body')}, {collapse("substr(case when draft_id % 5 = 0 then 'Else ' || hook_line else hook_line end, 1, 40)")}) as matches from drafts""", D)
def r4_body_matches(t):
    hook = F.expr("if(draft_id % 5 = 0, concat('Else ', hook_line), hook_line)")
    return t.drafts.select("draft_id", documents.body_matches(F.col("body"), hook).alias("matches"))


@register("r5_seo_tags", "select draft_id, meta_title || ' | Mag' as title, meta_description as description, draft_id % 2 = 0 as misplaced from drafts", D)
def r5_seo_tags(t):
    tags = documents.seo_tags(F.col("meta_title"), F.col("meta_description"), " | Mag")
    shifted = F.transform(tags, lambda x: x.withField("children", F.coalesce(x["children"], x["content"])).withField(
        "content", F.when(F.col("draft_id") % 2 == 1, x["content"])))
    return t.drafts.select("draft_id", tags[0]["children"].alias("title"), tags[1]["content"].alias("description"),
                           documents.misplaced_meta(shifted).alias("misplaced"))


@register("r6_draft_text", f"""
with {FD} select draft_id, sha256(hook_line || {_NL} || array_to_string(list_transform(sections, lambda s: {_NL} || '## ' || s.heading || {_NL} || {_NL} || s.body), {_NL}) || case when len(sections) > 0 then {_NL} else '' end || {_NL} || disclaimer) as h from fd""", D)
def r6_draft_text(t):
    return full_drafts(t).select("draft_id", F.sha2(documents.draft_text(
        F.col("hook_line"), F.col("sections"), F.col("disclaimer")), 256).alias("h"))


@register("m10_stage_metadata", "select draft_id, substr(meta_title, 1, 120) as title, meta_description as excerpt, 'guide' as category from drafts", D)
def m10_stage_metadata(t):
    return documents.stage_metadata(t.drafts, "guide")
