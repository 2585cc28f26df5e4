"""Quotation linking for chats: quote levels, links to quoted messages, and threads without quotes.

A line's quote level is the number of ``>`` it starts with. Every quoted line is a passage; its
normalised text is hashed and joined to the first message of the conversation that has the line as
its own. Lines that no message has, as they are wrapped anew or parts of a longer line, are joined by
hashed runs of words, over the lines of one level. Messages then form reply trees. Built-in functions and joins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listflow.llm.frames import packed
from listflow.session import cut_lineage

#: The marks of a quoted line.
_MARKS = r"^[ \t]*(?:>[ \t]*)+"
#: Words in a run by which parts of lines are found.
RUN = 5
# Fixed value: endings of the line that introduces a quote.
_INTRODUCES = r"(?i)(?:wrote|writes|said|schrieb|schreibt|a écrit|écrit|escribió|escribe)[ \t]*:[ \t]*$"


def quote_level(line: Column) -> Column:
    """How many quotes deep a line is."""
    marks = F.regexp_extract(line, _MARKS, 0)
    return F.length(marks) - F.length(F.translate(marks, ">", ""))


def normalised(line: Column) -> Column:
    """A line without quote marks, in lower case, with single blanks between words."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, _MARKS, "")), r"\s+", " "))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def own_text(text: Column) -> Column:
    """The text without its quoted lines and the lines that introduce them, trimmed."""
    lines = _lines(text)
    following = F.concat(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), F.array(F.lit("")))
    marked = F.zip_with(lines, following, lambda line, after: F.when(
        (quote_level(line) == 0) & ~(F.regexp_like(line, F.lit(_INTRODUCES)) & (quote_level(after) > 0)), line))
    return F.regexp_replace(F.array_join(F.array_compact(marked), "\n"), r"^\s+|\s+$", "")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _runs(items: Column) -> Column:
    """All runs of ``RUN`` neighbours."""
    places = F.when(F.size(items) >= RUN, F.sequence(F.lit(1), F.size(items) - RUN + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda p: F.slice(items, p, RUN))


def _short(words: Column) -> Column:
    """The unit of a sentence or line of fewer words than a run."""
    return F.md5(F.concat(F.lit("="), F.array_join(words, " ")))


def _is_short(words: Column) -> Column:
    return (F.size(words) > 0) & (F.size(words) < RUN)


def _link_parts(rows: DataFrame, missing: DataFrame) -> DataFrame:
    """(conv, turn, level, passage, part_origin) for quoted lines in ``missing`` that an earlier message has in part of its
    lines or over several.

    A line's units are the runs of words that touch it, over neighbouring lines of its level; a line that no run
    touches is one unit, which a sentence can equal. It links to the turn that first has most of its units, if that is half of them.
    """
    keys = ["conv", "turn", "level", "passage"]
    lines = F.transform(_lines(F.col("text")), lambda x: F.struct(
        quote_level(x).alias("level"), F.md5(normalised(x)).alias("passage"), _words(x).alias("words")))
    quoting = rows.join(missing.select("conv", "turn").distinct(), ["conv", "turn"], "left_semi").select("conv", "turn", lines.alias("lines"))
    # own lines between quotes part them
    stream = F.flatten(F.transform("lines", lambda x: F.when(x["level"] > 0, F.transform(x["words"], lambda w: F.struct(
        w.alias("w"), x["level"].alias("level"), x["passage"].alias("passage")))).otherwise(
        F.array(F.struct(F.lit("").alias("w"), F.lit(0).alias("level"), F.lit("").alias("passage"))))))
    runs = F.filter(_runs(F.col("stream")), lambda r: (r[0]["level"] > 0) & F.forall(r, lambda x: x["level"] == r[0]["level"]))
    touched = quoting.withColumn("stream", stream).select("conv", "turn", F.explode(runs).alias("run")).select(
        "conv", "turn", F.col("run")[0]["level"].alias("level"), F.explode(F.array_distinct(F.col("run")["passage"])).alias("passage"),
        F.md5(F.array_join(F.col("run")["w"], " ")).alias("unit"))
    short = quoting.select("conv", "turn", F.explode(F.filter("lines", lambda x: (x["level"] > 0) & _is_short(x["words"]))).alias("x")).select(
        "conv", "turn", F.col("x")["level"].alias("level"), F.col("x")["passage"].alias("passage"), _short(F.col("x")["words"]).alias("unit"))
    touched = cut_lineage(touched.distinct(), "runs")
    units = touched.unionByName(short.distinct().join(touched, keys, "left_anti"))
    units = cut_lineage(units.join(missing.select(*keys).distinct(), keys, "left_semi"), "units")
    own = rows.join(units.select("conv").distinct(), "conv", "left_semi").select("conv", "turn", own_text(F.col("text")).alias("own"))
    sentences = F.filter(F.transform(F.split("own", r"[.!?\u3002\uff01\uff1f]+|\n"), _words), _is_short)
    made = F.concat(F.transform(_runs(_words(F.col("own"))), lambda r: F.md5(F.array_join(r, " "))), F.transform(sentences, _short))
    first = (own.select("conv", "turn", F.explode(F.array_distinct(made)).alias("unit"))
             .join(units.select("conv", "unit").distinct(), ["conv", "unit"], "left_semi")
             .groupBy("conv", "unit").agg(F.min("turn").alias("origin")))
    found = units.join(first, ["conv", "unit"], "left").withColumn("origin", F.when(F.col("origin") < F.col("turn"), F.col("origin")))
    votes = found.groupBy(*keys, "origin").agg(F.count("*").alias("n")).groupBy(*keys).agg(
        F.sum("n").alias("total"), F.min(F.when(F.col("origin").isNotNull(), F.struct((-F.col("n")).alias("few"), "origin"))).alias("best"))
    return votes.filter("-2 * best.few >= total").select(*keys, F.col("best.origin").alias("part_origin"))


def link_quotes(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """(conv, turn, n_quoted, max_level, n_linked, reply_to) for the messages that quote.

    A quoted line links to the first earlier turn whose own text has it as a line, or else to one that has
    its words in a row (``_link_parts``). ``reply_to`` is the turn
    with most of the links at the lowest linked level, the latest of equals; null if none links. Rows
    of the same conversation and turn are one message here; null conversations or turns don't link.
    """
    rows = messages.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.col(text).alias("text"))
    rows = rows.filter("conv is not null and turn is not null")
    quoting = rows.filter(F.exists(_lines(F.col("text")), lambda x: quote_level(x) > 0))
    quoted = cut_lineage(
        quoting.select("conv", "turn", F.explode(F.filter(_lines(F.col("text")), lambda x: quote_level(x) > 0)).alias("line"))
        .select("conv", "turn", quote_level(F.col("line")).alias("level"), F.md5(normalised(F.col("line"))).alias("passage"),
                (normalised(F.col("line")) == "").alias("blank"))
        .distinct(), "quoted")
    # only passages that are quoted somewhere in the conversation are looked for
    wanted = quoted.filter("not blank").select("conv", "passage").distinct()
    own = rows.select("conv", "turn", F.explode(F.split(own_text(F.col("text")), "\n")).alias("line")).select(
        "conv", "turn", F.md5(normalised(F.col("line"))).alias("passage"))
    first = (own.join(wanted, ["conv", "passage"], "left_semi")
             .groupBy("conv", "passage").agg(F.min("turn").alias("origin")))
    linked = quoted.join(first, ["conv", "passage"], "left")
    linked = cut_lineage(linked.withColumn("origin", F.when(F.col("origin") < F.col("turn"), F.col("origin"))), "linked")
    missing = linked.filter("origin is null and not blank")
    if not missing.isEmpty():
        parts = _link_parts(rows, missing)
        linked = linked.join(parts, ["conv", "turn", "level", "passage"], "left").withColumn(
            "origin", F.coalesce("origin", "part_origin"))
    votes = linked.groupBy("conv", "turn", "level", "origin").agg(F.count_if(~F.col("blank")).alias("lines"))
    return votes.groupBy("conv", "turn").agg(
        F.sum("lines").alias("n_quoted"), F.max("level").cast("long").alias("max_level"),
        F.sum(F.when(F.col("origin").isNotNull(), F.col("lines")).otherwise(0)).alias("n_linked"),
        F.min(F.when(F.col("origin").isNotNull(), F.struct(
            "level", (-F.col("lines")).alias("few"), (-F.col("origin")).alias("early"), "origin")))["origin"].alias("reply_to"))


def _roots(replies: DataFrame) -> DataFrame:
    """(conv, turn, root, depth) of messages that reply, by doubling the step to an ancestor.

    After k rounds a message knows its ancestor 2^k replies up, so the rounds are the logarithm of
    the longest chain. Each round is one join on (conv, turn) of the replying messages.
    """
    state = cut_lineage(replies.select("conv", "turn", F.col("reply_to").alias("up"), F.lit(1).cast("long").alias("depth")), "replies")
    while True:
        above = state.select(F.col("conv").alias("_c"), F.col("turn").alias("_t"), F.col("up").alias("_up"), F.col("depth").alias("_d"))
        joined = state.join(above, (F.col("conv") == F.col("_c")) & (F.col("up") == F.col("_t")), "left")
        state, before = cut_lineage(joined.select(
            "conv", "turn", F.coalesce("_up", "up").alias("up"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"),
            F.col("_up").isNotNull().alias("_moved")), "replies"), state
        if not state.agg(F.max("_moved")).first()[0]:
            return before.select("conv", "turn", F.col("up").alias("root"), "depth")
        state = state.drop("_moved")


def thread_messages(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``messages`` without quotes, with where each stands in its conversation's threads.

    Added: ``own_text``, ``n_quoted``, ``max_level``, ``n_linked``, ``reply_to``, ``thread_turn`` (the
    turn that the thread starts with) and ``depth`` (replies from there). Sorted by conversation,
    ``thread_turn`` and turn, messages are in reply order: a reply follows what it answers and keeps
    to its thread. A message that links to nothing starts a thread. A message that only quotes has an
    empty own text. Rows with the same conversation and turn stay, with the same place; columns with
    the added names are replaced. No conversation is gathered, so its length has no bound.
    """
    made = ["own_text", "n_quoted", "max_level", "n_linked", "reply_to", "thread_turn", "depth"]
    kept = [c for c in messages.columns if c not in made]
    links = cut_lineage(link_quotes(messages, conversation, turn, text), "quotes")
    roots = _roots(links.filter("reply_to is not null"))
    places = links.join(roots, ["conv", "turn"], "left").select(
        F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), "n_quoted", "max_level", "n_linked", "reply_to", "root", "depth")
    rows = packed(messages, conv=F.col(conversation), at=F.col(turn), own_text=own_text(F.col(text))).join(
        places, (F.col("conv") == F.col("_conv")) & (F.col("at") == F.col("_turn")), "left")
    zero = F.lit(0).cast("long")
    return rows.select(
        *[F.col("row")[c].alias(c) for c in kept], "own_text",
        *[F.coalesce(c, zero).alias(c) for c in ("n_quoted", "max_level", "n_linked")], "reply_to",
        F.coalesce("root", "at").alias("thread_turn"), F.coalesce("depth", zero).alias("depth"))
