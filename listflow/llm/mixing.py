"""Mixing sources to target weights with hash-threshold histograms.

A document's place in its source is a hash of its id. Sizes are summed by source and hash bucket;
the bucket in which a source's budget ends is refined by the next bits, and so on, until the
threshold is one hash value. Documents below it are taken by a filter; nothing is sorted. A target
above the source's size takes every document once and those below the threshold of the rest again,
with the same hash, so the documents of a smaller budget are among those of a larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listflow.llm.frames import packed, unpacked
from listflow.operators.ranking import rank_within
from listflow.session import cut_lineage

#: A word, and the white space between words.
WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of a place, and digits by which one round of buckets is told apart.
PLACE_DIGITS, ROUND_DIGITS = 12, 3


def word_total(text: Column) -> Column:
    """Words of a text; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(key: Column, seed: str) -> Column:
    """A 48-bit hash as a long; the same key has the same place in every run."""
    text = F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, PLACE_DIGITS), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: tuple[int, int] = (3, 2),
                   most: int = 2) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources in code point order, null last, weigh ``weights``, repeating. They share ``share`` (a
    fraction) of all sizes; a target stops at ``most`` times its source, and the excess is shared
    again by weight until none is above. Each round is one aggregate over the sources.
    """
    ranked = rank_within(
        sizes.withColumn("_all", F.lit(0)), "_all", [F.col("source").isNull(), F.col("source")], "_at").drop("_all")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_at") - 1, F.lit(len(weights))) + 1).cast("int"))
    state = cut_lineage(ranked.withColumns({"_w": weight.cast("long"), "_cap": F.col("source_size") * most}), "sources")
    total = state.agg(F.sum("source_size")).first()[0] or 0
    number, per = share[0] * total, share[1]
    capped, bound = F.lit(False), -1
    while True:
        row = state.select(
            F.sum(F.when(capped, F.col("_cap")).otherwise(0)).alias("full"),
            F.sum(F.when(capped, 0).otherwise(F.col("_w"))).alias("open"),
            F.count_if(capped).alias("n")).first()
        if row.n == bound or not row.open:
            break
        bound = row.n
        # level = (share of the total - what full sources take) / open weight, kept as integers
        level, parts = number - per * row.full, per * row.open
        capped = F.col("_cap").cast("decimal(38,0)") * parts < F.col("_w").cast("decimal(38,0)") * F.lit(level).cast("decimal(38,0)")
    # integers up to the last step, so the doubles agree wherever they are computed
    fair = (F.col("_w") * F.lit(level)).cast("double") / F.lit(float(parts)) if bound >= 0 else F.lit(0.0)
    return state.select("source", "source_size", F.when(capped, F.col("_cap").cast("double")).otherwise(fair).alias("target"))


def _thresholds(places: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, low, left, tied): the boundary place, what its documents still get, and their size.

    ``budgets`` has (source, left). Each round sums the sizes by the next digits of the place inside
    the boundary bucket, so a round reads one bucket per source; it ends when the bucket is one place.
    A bucket's rank needs the buckets of one source only, which are at most 16 to the power of the digits.
    """
    state = budgets.select("source", "left", F.lit(0).cast("long").alias("low"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = 4 * PLACE_DIGITS
    while shift > 0:
        above, shift = shift, shift - 4 * ROUND_DIGITS
        inside = places.join(state, places["source"].eqNullSafe(state["source"])).select(
            places["source"], "place", "size", "left", "low")
        inside = inside.filter(F.shiftright("place", above) == F.shiftright("low", above))
        sums = inside.groupBy("source", F.shiftright("place", shift).alias("bucket")).agg(
            F.sum("size").alias("tied"), F.first("left").alias("left"))
        crossed = sums.withColumn("done", F.coalesce(F.sum("tied").over(before), F.lit(0)))
        state = cut_lineage(
            crossed.filter("done <= left and left < done + tied")
            .select("source", F.shiftleft("bucket", shift).alias("low"), (F.col("left") - F.col("done")).alias("left"), "tied"),
            "thresholds")
    return state


def source_limits(places: DataFrame) -> DataFrame:
    """What decides for the documents of a source, one row per source (columns start with ``_``).

    ``places`` has (source, size, place). ``_low`` is the boundary place: those below it are taken
    (again, where ``_whole``), those on it share ``_rest`` words; without one, all are, or none.
    """
    targets = cut_lineage(source_targets(places.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    whole = F.col("target") >= F.col("source_size")
    budgets = targets.withColumns({
        "whole": whole, "left": (F.floor("target") - F.when(whole, F.col("source_size")).otherwise(0)).cast("long")})
    edges = _thresholds(places, budgets).toDF("_edge_source", "_low", "_rest", "_tied")
    found = budgets.toDF("_source", "_size", "_target", "_whole", "_left").join(
        edges, F.col("_source").eqNullSafe(F.col("_edge_source")), "left").drop("_edge_source")
    return cut_lineage(found, "limits")


def _shared(size: Column) -> Column:
    """Words of a document of this size on the boundary place."""
    return F.call_function("div", F.col("_rest") * size, F.greatest(F.col("_tied"), F.lit(1)))


def _taken(size: Column, at: Column) -> Column:
    """Words taken of a document of this size and place, given its source's limits."""
    more = (F.when(F.col("_low").isNull(), F.when(F.col("_left") > 0, size).otherwise(0))
            .when(at < F.col("_low"), size).when(at > F.col("_low"), 0).otherwise(_shared(size)))
    return (F.when(F.col("_whole"), size).otherwise(0) + more).cast("long")


def _edge_limits(places: DataFrame, limits: DataFrame) -> DataFrame:
    """``limits`` with the boundary among the texts on a source's boundary place: ``_edge_low`` is a hash of
    a text, those below it are taken whole, and the copies of the one on it get ``_edge_rest`` words.

    Together they get what ``_taken`` gives them.
    """
    edge = places.join(limits, places["source"].eqNullSafe(limits["_source"])).filter("place = _low")
    shared = _shared(F.col("size"))
    edge = cut_lineage(edge.select("source", "size", F.col("mark").alias("place"), shared.alias("shared")), "edge")
    found = _thresholds(edge, cut_lineage(edge.groupBy("source").agg(F.sum("shared").alias("left")), "shared"))
    found = found.toDF("_edge_source", "_edge_low", "_edge_rest", "_edge_tied")
    return cut_lineage(limits.join(found, F.col("_source").eqNullSafe(F.col("_edge_source")), "left").drop(
        "_edge_source", "_edge_tied"), "limits")


def _places(docs: DataFrame, key: str, source: str, text: str, seed: str, **more: Column) -> DataFrame:
    return cut_lineage(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), word_total(F.col(text)).alias("size"),
        place(F.col(key), seed).alias("place"), *[v.alias(k) for k, v in more.items()]), "places")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: str = "mix:") -> DataFrame:
    """(doc_id, source, size, place, source_size, target, taken) for every document.

    ``taken`` counts the words that the mix takes: none, one or two copies of the document, and part
    of a copy only at its source's boundary place, which gets what is left of the budget. Documents
    that share this place, such as repeated rows, get shares by size. So a source's taken words miss
    its target by fewer words than such documents. A null id has a place like any other. Texts are
    read once; all that follows reads the id, source, size and place from the shared folder.
    """
    places = _places(docs, key, source, text, seed)
    limits = source_limits(places)
    return places.join(limits, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "place", F.col("_size").alias("source_size"), F.col("_target").alias("target"),
        _taken(F.col("size"), F.col("place")).alias("taken"))


def apply_mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
              seed: str = "mix:") -> DataFrame:
    """``docs`` as the mix takes them, with the columns of ``docs``.

    A document taken twice is there in two rows. Texts that share a source's boundary place, such as
    those with a null or repeated id, are told apart by a hash of the text. Every document is taken whole or
    not at all: of a source's one document that ``mix`` takes in part, the nearer of the two. So a source's
    words differ from what ``mix`` takes by half of one document at most. Documents without words go.
    """
    mark = place(F.md5(F.coalesce(F.col(text), F.lit(""))), seed)
    places = _places(docs, key, source, text, seed, mark=mark)
    limits = _edge_limits(places, source_limits(places))
    own = packed(docs, words=word_total(F.col(text)), at=place(F.col(key), seed), of=F.col(source), mark=mark)
    own = own.join(limits, F.col("of").eqNullSafe(F.col("_source")))
    on_edge = F.coalesce(F.col("at") == F.col("_low"), F.lit(False))
    tied = on_edge & F.coalesce(F.col("mark") == F.col("_edge_low"), F.lit(False))
    more = F.when(on_edge & (F.col("mark") < F.col("_edge_low")), F.col("words")).otherwise(0)
    apart = own.filter(~tied).withColumn("taken", F.when(
        on_edge, F.when(F.col("_whole"), F.col("words")).otherwise(0) + more).otherwise(_taken(F.col("words"), F.col("at"))))
    # copies of the text on the boundary, mostly one row: as many as come nearest
    group = F.when(F.col("of").isNull(), "").otherwise(F.concat(F.lit("="), F.col("of").cast("string")))
    copies = rank_within(own.filter(tied).withColumn("_group", group), "_group", [F.monotonically_increasing_id()], "_nth")
    before = (F.col("_nth") - 1) * F.col("words")
    part = F.when(2 * (F.col("_edge_rest") - before) >= F.col("words"), F.col("words")).otherwise(0)
    copies = copies.withColumn("taken", F.when(F.col("_whole"), F.col("words")).otherwise(0) + part)
    names = ["row", "words", "taken"]
    own = apart.select(*names).unionByName(copies.select(*names)).filter("words > 0")
    return unpacked(own.withColumn("n", F.explode(F.sequence(F.lit(0), F.floor(F.col("taken") / F.col("words")).cast("int")))).filter(
        "n > 0"), docs.columns)
