"""Text gates and documents on written cases."""

import json
import random
import re

from pyspark.sql import functions as F

from listflow import constants as K
from listflow.operators import documents, gates

SCHEMA = ("draft_id long, event_id long, hook_line string, sections array<struct<heading:string,body:string>>, "
          "disclaimer string, meta_title string, meta_description string, slug_stem string, links array<string>")


def draft(i=1, n=5, words=180, hook="Rowing Regatta returns.", body=None, **other):
    sections = [(f"Heading {k}", (body or "Ballard word " * (words // 2)).strip()) for k in range(n)]
    row = dict(disclaimer=K.DISCLAIMER, meta_title="Rowing Regatta on the Cut",
               meta_description="Rowing Regatta, August 22 in Ballard.", slug_stem="rowing-regatta-cut", links=[])
    row.update(other)
    return (i, i, hook, sections, row["disclaimer"], row["meta_title"], row["meta_description"], row["slug_stem"], row["links"])


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def events(spark, n=9):
    return spark.range(1, n).selectExpr("id as event_id", "timestamp_ntz'2026-08-22 09:00:00' as start_dt",
                                        "'Ballard' as neighborhood", "'Rowing Regatta' as title")


def test_gate_order(spark):
    got = gates.draft_gate(frame(
        spark, draft(1), draft(2, n=4), draft(3, words=40), draft(4, hook="Now — go"), draft(5, n=7, hook="—"))).orderBy("draft_id")
    assert [r["reason"] for r in got.collect()] == [
        None, "4 sections, expected 5-6", "200 words of prose, expected 800-1155", "em-dash present", "7 sections, expected 5-6"]


def test_lexicon_word_boundaries(spark):
    df = spark.createDataFrame([
        (1, "A VIBRANT, cutting-edge deep dive. Dive  deep; elevated. Vital vital."), (2, "revitalize évital vitals"),
        (3, "Certainly! You can, you can. uncertainly!"), (4, "deep dive deep")], "doc_id long, text string")
    got = {(r["doc_id"], r["category"], r["term"]): r["n"] for r in gates.lexicon_hits(df).collect()}
    v = "banned_vocabulary"
    assert got == {(1, v, "vibrant"): 1, (1, v, "cutting-edge"): 1, (1, v, "deep dive"): 1, (1, v, "dive deep"): 1, (1, v, "vital"): 2,
                   (3, "banned_phrase", "certainly!"): 1, (3, "second_person", "you can"): 2,
                   (4, v, "deep dive"): 1, (4, v, "dive deep"): 1}


def test_lexicon_counts_as_patterns_do(spark):
    lexicon = {"a": ["ha ha", "certainly!", "state-of-the-art", "ok", "n°", "-free"], "b": [f"word{i}" for i in range(2000)] + ["ok"]}
    parts = ["ha", "Ha", "certainly!", "certainly", "!", "state-of-the-art", "state", "-", "of", "ok", "OK.", "n°", "-free", "x", "é", "word7",
             "word77", "\x01", "\n", "  ", "°"]
    draw = random.Random(6)
    texts = ["".join(draw.choice(parts) + draw.choice(["", " ", " ", "\n\t"]) for _ in range(30)) for _ in range(60)] + ["", "ok"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "doc_id long, text string")
    got = {(r["doc_id"], r["category"], r["term"]): r["n"] for r in gates.lexicon_hits(df, lexicon).collect()}
    want = {}
    for i, t in enumerate(texts):
        for c, listed in lexicon.items():
            for x in listed:
                quoted = r"[ \t\n\x0b\f\r]+".join(map(re.escape, x.split()))
                n = len(re.findall(rf"(?<![^\W_]){quoted}(?![^\W_])", t.lower()))
                if n:
                    want[i, c, x] = n
    assert got == want
    inside = {(r["doc_id"], r["term"]): r["n"] for r in gates.lexicon_hits(df, {"a": ["ha", "k"]}, mode="substring").collect()}
    assert inside == {(i, x): t.lower().count(x) for i, t in enumerate(texts) for x in ("ha", "k") if x in t.lower()}


def test_metadata_rules(spark):
    rows = [draft(1), draft(2, meta_title="x" * 61), draft(3, meta_title="A | B"), draft(4, meta_description="Soon in Ballard"),
            draft(5, slug_stem="regatta-august-2026"), draft(6, hook="w " * 31), draft(7, disclaimer="Other."), draft(8, slug_stem="Row!")]
    got = gates.metadata_gate(frame(spark, *rows), events(spark)).orderBy("draft_id").collect()
    assert [r["misses"] for r in got] == [
        [], ["title_length"], ["title_pipe"], ["description_date"], ["slug_date"], ["hook_length"], ["disclaimer"],
        ["slug_characters", "slug_tokens"]]


def test_seo_caps(spark):
    good = "Rowing Regatta day in Ballard. " + "word " * 170
    rows = [draft(1, body="Ballard word " * 60), draft(2, meta_title="Other"), draft(3, body=good)]
    got = {r["draft_id"]: r for r in gates.seo_score_cap(
        frame(spark, *rows), events(spark), spark.createDataFrame([("a",)], "slug string")).collect()}
    assert got[2]["score_cap"] == 4 and got[2]["hard_misses"] == ["phrase_missing"]
    assert got[1]["score_cap"] == 7 and "phrase_in_no_heading" in got[1]["defects"]
    assert "stuffing" in got[3]["defects"]


def test_links(spark):
    d = frame(spark, draft(1, links=['"word" -> a']), draft(2, links=['"click here" -> b', '"absent" -> b']))
    got = {r["draft_id"]: r for r in gates.audit_links(d, spark.createDataFrame([("a",)], "slug string")).collect()}
    assert got[1]["ok"] and not got[2]["ok"]
    assert (got[2]["invented_targets"], got[2]["repeated_targets"], got[2]["bad_anchors"]) == (2, 1, 2)


def test_document_shape(spark):
    e = events(spark).selectExpr("*", "'Pier' as venue_name", "'1 Dock St' as venue_address", "'$5' as price", "' ' as register_url",
                                 "array(named_struct('stop_name','Pine','routes',array('1','2','3','4'),'distance_m',80,'mode','bus')) as transit")
    boxed = documents.details_box(e).select("event_id", "details", F.lit("https://i.example/a.jpg").alias("image_url"), F.lit("Alt").alias("image_alt"))
    doc = documents.build_document(frame(spark, draft(1, n=2, body="One.\n\nTwo.")).join(boxed, "event_id"))
    nodes = json.loads(doc.select(documents.render(F.col("nodes"))).first()[0])["nodes"]
    assert [n["type"] for n in nodes] == ["PARAGRAPH"] * 5 + ["IMAGE", "PARAGRAPH"] + ["HEADING", "PARAGRAPH", "PARAGRAPH"] * 2 + ["PARAGRAPH"]
    assert [r["text"] for r in nodes[4]["runs"]] == ["\n", "Getting there: ", "Pine (1, 2, 3), 80m away", "\n"]
    assert [r["bold"] for r in nodes[1]["runs"]] == [False, True, False, False]
    assert nodes[6]["runs"] == [{"text": "\n", "bold": False}] and nodes[7]["level"] == 2
    once = documents.prepend_banner(F.col("nodes"), F.lit("This event has ended."))
    twice = doc.withColumn("nodes", once).withColumn("again", documents.prepend_banner(F.col("nodes"), F.lit("This event has ended.")))
    assert twice.select(F.size("nodes") == F.size("again")).first()[0]


def test_editor_and_history(spark):
    d = frame(spark, draft(1), draft(2), draft(3))
    e = spark.createDataFrame([(1, "PASS", "fine", "New hook", "", None), (2, "HOLD", "thin", "x", None, None)],
                              "draft_id long, verdict string, reason string, hook_line string, meta_title string, meta_description string")
    got = {r["draft_id"]: r for r in gates.editor_route(d, e).collect()}
    assert (got[1]["hook_line"], got[1]["meta_title"], got[1]["route"]) == ("New hook", "Rowing Regatta on the Cut", "next")
    assert (got[2]["hook_line"], got[2]["hold_reason"]) == ("Rowing Regatta returns.", "held by editor: thin")
    assert got[3]["route"] == "waiting"


def test_a_longer_day_number_is_another_date(spark):
    df = spark.createDataFrame([("On August 22 at noon", "2026-08-02"), ("On August 2, noon", "2026-08-02"),
                                ("Aug 2", "2026-08-02"), ("Sept 2", "2026-08-02"), ("see Aug 22.", "2026-08-22")], "c string, d string")
    got = df.select(gates._states_date(F.col("c"), F.col("d").cast("timestamp_ntz")).alias("ok")).collect()
    assert [r.ok for r in got] == [False, True, True, False, True]


def test_a_draft_nobody_judged_is_incomplete(spark):
    drafts = spark.createDataFrame([(1,), (2,)], "draft_id long")
    verdicts = spark.createDataFrame([(1, d, 9) for d in K.JUDGE_DIMENSIONS], "draft_id long, dimension string, score int")
    got = {r["draft_id"]: (r["outcome"], len(r["missing"])) for r in gates.judge_panel(verdicts, drafts).collect()}
    assert got == {1: ("pass", 0), 2: ("incomplete", len(K.JUDGE_DIMENSIONS))}
