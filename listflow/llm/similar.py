"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

Equal texts are joined once, as a class. Texts whose minimum hashes agree in a band share a bucket.
Classes are found in rounds: every text of a bucket is compared with one representative, linked
texts become one class over all buckets, and only buckets that still hold several classes go on. A
class of m near copies so costs about m comparisons a round. What rounds don't settle is compared
whole, but only across classes: the largest class of a bucket against the others, in cells of blocks.

The number of links of a text is another matter: it needs every pair of its class, so its cells
grow with the square of a class. It is a step of its own (``links``), within classes only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listflow.llm.frames import packed, schema_with, unpacked
from listflow.llm.textbytes import byte_slices, flat, mixed, word_hashes, words
from listflow.operators.matching import connected_components
from listflow.session import cut_lineage

#: Texts in a block; a cell holds two blocks at most.
BLOCK = 256
#: Texts whose sets are fetched by a broadcast of their hashes (16 bytes each); beyond it by a shuffle.
MAX_BROADCAST = 200_000


def choose_bands(similarity: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows) that find a pair of this similarity with the target recall.

    A pair shares a band with probability 1 - (1 - s^rows)^bands. More rows mean fewer chance
    meetings, so the largest number of rows whose bands fit into ``most_hashes`` is taken.
    """
    best = None
    for rows in range(1, most_hashes + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows)))
        if bands * rows > most_hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("the recall needs more hashes")
    return best


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per text) of all runs of ``width`` words; a shorter text with words has one, of all of them."""
    starts, ends, at = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    count = np.diff(at)
    runs = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    first = np.repeat(at[:-1], runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    length = np.minimum(np.repeat(count, runs), width)
    out = length.astype(np.uint64)
    for k in range(width):
        inside = length > k
        out[inside] = mixed(out[inside] * np.uint64(0x9E3779B97F4A7C15) + hashes[first[inside] + k])
    return out, np.concatenate([[0], np.cumsum(runs)])


def band_hashes(values: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands): each band's minimum hashes in one value; texts without shingles have zeros."""
    out = np.zeros((len(offsets) - 1, bands), np.uint64)
    filled = np.flatnonzero(np.diff(offsets))
    if not len(filled):
        return out
    begin = offsets[:-1][filled]
    rng = np.random.Generator(np.random.PCG64(20))
    masks = rng.integers(0, 2**63, bands * rows, np.uint64)
    factors = rng.integers(0, 2**63, bands * rows, np.uint64) | np.uint64(1)
    for band in range(bands):
        joined = np.full(len(filled), band + 1, np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            least = np.minimum.reduceat((values ^ masks[k]) * factors[k], begin)
            joined = mixed(joined * np.uint64(0x9E3779B97F4A7C15) + least)
        out[filled, band] = joined
    return out


def _signatures(docs: DataFrame, bands: int, rows: int, width: int) -> DataFrame:
    """(doc_id, h, n, bands) from (doc_id, h, text): distinct shingles and band hashes."""
    schema = schema_with(docs, ["doc_id", "h"], "n int, bands binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", 1 << 20):
                values, at = shingles(*flat(part["text"]), width)
                found = band_hashes(values, at, bands, rows)
                n = [len(np.unique(values[a:b])) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["h"], pa.array(n, pa.int32()), pa.array([x.tobytes() for x in found], pa.binary())],
                    names=["doc_id", "h", "n", "bands"])

    return docs.mapInArrow(run, schema)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(h, shingles) from (h, text): the sorted shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", 1 << 20):
                values, at = shingles(*flat(part["text"]), width)
                sets = [np.unique(values[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([part["h"], pa.array(sets, pa.binary())], names=["h", "shingles"])

    return docs.mapInArrow(run, "h string, shingles binary")


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """One frame per run of equal keys in sorted batches."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        key = rows[keys].to_numpy()
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist()]
        for a, b in zip(edges, edges[1:]):
            yield rows.iloc[a:b]
        rest = rows.iloc[edges[-1]:]
    if rest is not None:
        yield rest


def _candidates(cell: pd.DataFrame, bands: int, similarity: float) -> np.ndarray:
    """(pairs, 2): places in the cell of pairs that meet here first and whose set sizes allow the similarity.

    In a cell of two blocks, only pairs across them. A pair that agrees in an earlier band is that
    band's, so every pair is looked at once. Texts with one ``part`` are known to be of one class and are
    no pair; a null part says nothing.
    """
    own = np.frombuffer(b"".join(cell["bands"]), np.uint64).reshape(-1, bands)
    n = cell["n"].to_numpy()
    band, i, j = (int(cell[c].iloc[0]) for c in ("band", "i", "j"))
    block = cell["block"].to_numpy()
    known = cell["part"].notna().all()
    part = cell["part"].to_numpy()
    left, right = (np.flatnonzero(block == i), np.flatnonzero(block == j)) if i != j else (np.arange(len(cell)),) * 2
    found = []
    step = max(1, (1 << 22) // max(1, len(right) * max(1, band)))
    for at in range(0, len(left), step):
        some = left[at:at + step]
        low, high = np.minimum(n[some][:, None], n[right]), np.maximum(n[some][:, None], n[right])
        fits = (low >= similarity * high - 1e-9) & (low > 0)
        if known:
            fits &= part[some][:, None] != part[right]
        if band:
            fits &= ~(own[some, None, :band] == own[None, right, :band]).any(axis=2)
        a, b = np.nonzero(fits)
        pairs = np.stack([some[a], right[b]], axis=1)
        found.append(pairs if i != j else pairs[pairs[:, 0] < pairs[:, 1]])
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _verified(sets: list[np.ndarray], pairs: np.ndarray, similarity: float, columns: int = 4096) -> np.ndarray:
    """Which pairs of sets have at least this Jaccard similarity.

    A shingle of one set only is in no intersection; the others are columns of a 0-1 matrix whose
    product with itself counts what sets share.
    """
    sizes = np.array([len(s) for s in sets])
    if len(pairs) <= 8:
        shared = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in pairs])
    else:
        used = np.unique(pairs)
        place = np.zeros(len(sets), np.int64)
        place[used] = np.arange(len(used))
        _, column, count = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(used)), sizes[used])
        number = np.cumsum(count > 1) - 1
        keep = count[column] > 1
        row, column = row[keep], number[column[keep]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        product = np.zeros((len(used), len(used)), np.float64)
        for first in range(0, int(number[-1]) + 1 if len(number) else 0, columns):
            a, b = np.searchsorted(column, [first, first + columns])
            part = np.zeros((len(used), columns), np.float32)
            part[row[a:b], column[a:b] - first] = 1
            product += part @ part.T
        shared = product[place[pairs[:, 0]], place[pairs[:, 1]]]
    union = sizes[pairs[:, 0]] + sizes[pairs[:, 1]] - shared
    return shared >= similarity * union - 1e-9


def _forest(names: list[str], pairs: np.ndarray) -> list[str]:
    """For each place the least name of the places that the pairs connect it with."""
    label = np.argsort(np.argsort(np.array(names), kind="stable"), kind="stable")
    by_rank = sorted(names)
    while len(pairs):
        low = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        new = label.copy()
        np.minimum.at(new, pairs[:, 0], low)
        np.minimum.at(new, pairs[:, 1], low)
        if (new == label).all():
            break
        label = new
    return [by_rank[k] for k in label]


_CELL = ["bucket", "band", "i", "j"]


def _cell_job(rows: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """``work`` on each cell; rows of a cell meet in one task and come in sorted runs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in _runs(batches, _CELL):
            if len(cell) > 1:
                made = work(cell)
                if made is not None and len(made):
                    yield made

    return rows.repartition(*_CELL).sortWithinPartitions(*_CELL).mapInPandas(run, schema)


def _needed_sets(docs: DataFrame, names: DataFrame, width: int, max_broadcast: int) -> DataFrame:
    """(h, shingles) of the texts in ``names`` (h), once each; copies have equal sets, so any one stands for all."""
    needed = cut_lineage(names.distinct(), "needed")
    found = docs.join(F.broadcast(needed) if needed.count() <= max_broadcast else needed, "h", "left_semi")
    return _sets(found, width).groupBy("h").agg(F.first("shingles").alias("shingles"))


def _shared_buckets(texts: DataFrame, bands: int) -> DataFrame:
    """(h, n, band, bucket, part) for every bucket of several ``texts`` (h, n, bands); each text is its own part."""
    # a band's hash is in eight bytes of the signature
    buckets = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.struct(
        k.alias("band"), F.xxhash64(k, F.substring(F.hex("bands"), k * 16 + 1, F.lit(16))).alias("bucket")))
    met = texts.filter("n > 0").select("h", "n", F.explode(buckets).alias("b")).select("h", "n", "b.band", "b.bucket")
    many = met.groupBy("bucket", "band").agg(F.count("*").alias("m")).filter("m > 1").drop("m")
    return met.join(many, ["bucket", "band"]).select("h", "n", "band", "bucket", F.col("h").alias("part"))


def _open_buckets(met: DataFrame) -> DataFrame:
    """(bucket, band, main, m_main, n_main, m_rest, n_rest) of buckets with several parts: the largest part, and the
    texts and shingles in it and outside it."""
    parts = met.groupBy("bucket", "band", "part").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    sums = parts.groupBy("bucket", "band").agg(
        F.max(F.struct("m", "n", "part")).alias("main"), F.sum("m").alias("m"), F.sum("n").alias("n"))
    return sums.select("bucket", "band", F.col("main.part").alias("main"), F.col("main.m").alias("m_main"),
                       F.col("main.n").alias("n_main"), (F.col("m") - F.col("main.m")).alias("m_rest"),
                       (F.col("n") - F.col("main.n")).alias("n_rest")).filter("m_rest > 0")


def _star_pairs(met: DataFrame, turn: int, similarity: float) -> DataFrame:
    """(h, rep): texts with their bucket's representative of this turn, of another part and of a size that allows a link."""
    order = F.struct(F.xxhash64(F.lit(turn), "h").alias("o"), "h", "n", "part")
    reps = met.groupBy("bucket", "band").agg(F.min(order).alias("r"))
    fits = F.least("n", "r.n") >= similarity * F.greatest("n", "r.n") - 1e-9
    return met.join(reps, ["bucket", "band"]).filter((F.col("part") != F.col("r.part")) & fits).select(
        "h", F.col("r.h").alias("rep")).distinct()


def _star_links(pairs: DataFrame, docs: DataFrame, similarity: float, width: int, block: int, max_broadcast: int) -> DataFrame:
    """(src, dst): the ``pairs`` (h, rep) whose sets are similar.

    A representative's texts are dealt over slices, each with a copy of its set before them, which is all
    that a task keeps.
    """
    dealt = pairs.join(pairs.groupBy("rep").agg(F.count("*").alias("m")), "rep").select(
        "h", "rep", F.pmod(F.xxhash64("h"), F.ceil(F.col("m") / block)).cast("int").alias("slice"), F.lit(1).alias("role"))
    heads = dealt.select(F.col("rep").alias("h"), "rep", "slice", F.lit(0).alias("role")).distinct()
    rows = dealt.unionByName(heads)
    rows = rows.join(_needed_sets(docs, rows.select("h"), width, max_broadcast), "h")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head = np.zeros(0, np.uint64)
        for batch in batches:
            linked = []
            for h, rep, role, data in zip(batch["h"], batch["rep"], batch["role"], batch["shingles"]):
                own = np.frombuffer(data, np.uint64)
                if role == 0:
                    head = own
                    continue
                at = np.minimum(np.searchsorted(head, own), len(head) - 1)
                shared = int((head[at] == own).sum())
                if shared >= similarity * (len(own) + len(head) - shared) - 1e-9:
                    linked.append((rep, h))
            if linked:
                yield pd.DataFrame(linked, columns=["src", "dst"])

    return rows.repartition("rep", "slice").sortWithinPartitions("rep", "slice", "role").select(
        "h", "rep", "role", "shingles").mapInPandas(run, "src string, dst string")


def _blocks(texts: Column, shingle_count: Column, block: int) -> Column:
    """Blocks for so many texts: at most about ``block`` texts and a million shingles in each."""
    return F.ceil(F.greatest(texts / block, shingle_count / (1 << 20))).cast("int")


def _across(met: DataFrame, texts: DataFrame, open_buckets: DataFrame, block: int) -> DataFrame:
    """Cells of all pairs of different parts: the blocks outside a bucket's largest part against all its blocks."""
    first, more = _blocks(F.col("m_main"), F.col("n_main"), block), _blocks(F.col("m_rest"), F.col("n_rest"), block)
    own = met.join(open_buckets, ["bucket", "band"]).select(
        "h", "bucket", "band", F.xxhash64("part").alias("part"), (F.col("part") != F.col("main")).alias("rest"),
        first.alias("first"), more.alias("more"))
    slot = F.xxhash64("h")
    own = own.withColumn("block", F.when(F.col("rest"), F.col("first") + F.pmod(slot, "more")).otherwise(F.pmod(slot, "first")).cast("int"))
    other = F.sequence(F.when(F.col("rest"), F.lit(0)).otherwise(F.col("first")), F.col("first") + F.col("more") - 1)
    return _placed(own, texts, other)


def _within(met: DataFrame, texts: DataFrame, block: int) -> DataFrame:
    """Cells of all pairs of one part, for counts of links."""
    key = ["bucket", "band", "part"]
    sums = met.groupBy(*key).agg(F.count("*").alias("m"), F.sum("n").alias("s")).filter("m > 1")
    own = met.join(sums, key).withColumn("blocks", _blocks(F.col("m"), F.col("s"), block)).withColumns({
        "block": F.pmod(F.xxhash64("h"), "blocks").cast("int"), "bucket": F.xxhash64("bucket", "part"),
        "part": F.lit(None).cast("long")})
    return _placed(own, texts, F.sequence(F.lit(0), F.col("blocks") - 1))


def _placed(own: DataFrame, texts: DataFrame, other: Column) -> DataFrame:
    """A row for each text and cell: its block with each of the ``other`` blocks."""
    rows = own.select("h", "bucket", "band", "part", "block", F.explode(other).alias("other")).join(texts, "h")
    return rows.select("h", "w", "n", "bands", "bucket", "band", "part", "block",
                       F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def _cell_links(cells: DataFrame, docs: DataFrame, similarity: float, bands: int, width: int, max_broadcast: int) -> DataFrame:
    """(h, links, low) for the cells: links that a text has in a cell, counted with copies, and the
    least text it is connected with there."""
    columns = "h string, w long, n int, bands binary, bucket long, band int, part long, block int, i int, j int"

    def meeting(cell: pd.DataFrame) -> pd.DataFrame:
        return cell.iloc[np.unique(_candidates(cell, bands, similarity))]

    met_first = cut_lineage(_cell_job(cells, meeting, columns), "cells")
    sets = _needed_sets(docs, met_first.select("h"), width, max_broadcast)

    def verify(cell: pd.DataFrame) -> pd.DataFrame | None:
        pairs = _candidates(cell, bands, similarity)
        sets_here = [np.frombuffer(s, np.uint64) for s in cell["shingles"]]
        pairs = pairs[_verified(sets_here, pairs, similarity)] if len(pairs) else pairs
        if not len(pairs):
            return None
        weight, links = cell["w"].to_numpy(), np.zeros(len(cell), np.int64)
        np.add.at(links, pairs[:, 0], weight[pairs[:, 1]])
        np.add.at(links, pairs[:, 1], weight[pairs[:, 0]])
        names = cell["h"].tolist()
        return pd.DataFrame({"h": names, "links": links, "low": _forest(names, pairs)})[links > 0]

    return _cell_job(met_first.join(sets, "h"), verify, "h string, links long, low string")


def _classes(met: DataFrame, texts: DataFrame, docs: DataFrame, similarity: float, bands: int, width: int, block: int,
             max_broadcast: int) -> DataFrame:
    """(h, part) for every text with a link: the least text of its class.

    Rounds go on while cells would move over three times the rows of the open buckets and the last
    round left at most three quarters of the texts outside their buckets' largest parts. How many rounds there are
    changes the work, not the result.
    """
    labels = None
    turn, left = 0, None
    while True:
        edges = cut_lineage(_star_links(cut_lineage(_star_pairs(met, turn, similarity), "pairs"), docs, similarity, width,
                                        block, max_broadcast), "links")
        labels = _relabelled(labels, edges)
        # two texts of a bucket have been compared by the first round
        apart = _relabel(met, labels)
        if turn == 0:
            apart = apart.join(apart.groupBy("bucket", "band").agg(F.count("*").alias("m")).filter("m > 2").drop("m"),
                               ["bucket", "band"])
        still = cut_lineage(_open_buckets(apart), "open")
        first, more = _blocks(F.col("m_main"), F.col("n_main"), block), _blocks(F.col("m_rest"), F.col("n_rest"), block)
        sums = still.agg(F.sum("m_rest").alias("rest"), F.sum(F.col("m_main") + F.col("m_rest")).alias("rows"), F.sum(
            F.col("m_main") * more + F.col("m_rest") * (first + more)).alias("cells")).first()
        before, left = left, sums["rest"]
        if not left:
            return labels
        met = cut_lineage(apart.join(still.select("bucket", "band"), ["bucket", "band"], "left_semi"), "met")
        if sums["cells"] <= 3 * sums["rows"] or before is not None and 4 * left > 3 * before:
            break
        turn += 1
    found = cut_lineage(_cell_links(_across(met, texts, still, block), docs, similarity, bands, width, max_broadcast), "links")
    return _relabelled(labels, found.filter("h <> low").select(F.col("low").alias("src"), F.col("h").alias("dst")))


def _relabel(met: DataFrame, labels: DataFrame) -> DataFrame:
    return met.drop("part").join(labels, "h", "left").withColumn("part", F.coalesce("part", "h"))


def _relabelled(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """(h, part) of the classes that the earlier ``labels`` and the ``edges`` make."""
    if labels is not None:
        edges = edges.unionByName(labels.filter("h <> part").select(F.col("part").alias("src"), F.col("h").alias("dst")))
    return connected_components(edges).select(F.col("id").alias("h"), F.col("component").alias("part"))


def join_similar(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8, width: int = 5,
                 recall: float = 0.9999, block: int = BLOCK, max_broadcast: int = MAX_BROADCAST, links: bool = True) -> DataFrame:
    """(doc_id, h, n_shingles, class_id, n_links, component) for every document.

    Two documents are linked if the sets of their runs of ``width`` words (as split by white space;
    all words of a shorter text) have at least this Jaccard similarity. ``n_links`` counts a
    document's links, copies included; without ``links`` it is not computed and null, and the work for a class
    is in proportion to its texts. ``class_id`` is the least id that links lead to. Texts
    without words link to nothing and are their own class; so does a null id, whose class is the
    least id among its links or null. ``h`` is the text's md5, and ``component`` the md5 of one text of the
    class, which no other class has; classes may share an id that is null or repeated. Pairs of different texts are found with
    the given recall at the threshold, and almost surely above it.
    """
    bands, rows = choose_bands(similarity, recall)
    named = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    named = named.select("doc_id", F.md5("text").alias("h"), "text")
    signed = cut_lineage(_signatures(named, bands, rows, width), "signatures")
    texts = cut_lineage(signed.groupBy("h").agg(
        F.count("*").alias("w"), F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands")), "texts")
    own, whole = texts.select("h", "w", "n", "bands"), named.select("h", "text")
    met = cut_lineage(_shared_buckets(texts, bands), "met")
    parts = cut_lineage(_classes(met, own, whole, similarity, bands, width, block, max_broadcast), "parts")
    joined = texts.select("h", "w", "least", "n").join(parts.withColumnRenamed("part", "component"), "h", "left")
    if links:
        linked = met.drop("part").join(parts, "h")
        found = _cell_links(_within(linked, own, block), whole, similarity, bands, width, max_broadcast)
        joined = joined.join(found.groupBy("h").agg(F.sum("links").alias("links")), "h", "left")
        n_links = F.when(F.col("n") == 0, F.lit(0)).otherwise(F.col("w") - 1 + F.coalesce("links", F.lit(0)))
    else:
        n_links = F.lit(None)
    joined = cut_lineage(joined.select("h", F.coalesce("component", "h").alias("component"), "least", "n",
                                       n_links.cast("long").alias("n_links")), "classes")
    classes = joined.groupBy("component").agg(F.min("least").alias("class_id"))
    ends = joined.join(classes, "component").select("h", "component", "class_id", "n_links")
    return signed.select("doc_id", "h", "n").join(ends, "h").select(
        "doc_id", "h", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "n_links", "component")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class, with the columns of ``docs``: the one with the least id.

    Of repeated ids in a class, the one whose text hash is least stays, and of repeated rows one.
    Documents without words all stay.
    """
    joined = join_similar(docs, key, text, links=False, **options)
    first = joined.filter("n_shingles > 0").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("first"))
    keep = first.select(F.col("first.doc_id").alias("_key"), F.col("first.h").alias("_h"))
    whole = F.coalesce(F.col(text), F.lit(""))
    own = packed(docs, id=F.col(key), own=F.md5(whole), filled=F.regexp_like(whole, F.lit(r"[^\x20\x09-\x0D]")))
    kept = (own.filter("filled").join(keep, F.col("id").eqNullSafe(F.col("_key")) & (F.col("own") == F.col("_h")))
            .dropDuplicates(["_key", "_h"]))
    return unpacked(kept, docs.columns).unionByName(unpacked(own.filter("not filled"), docs.columns))
