"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed on Arrow batches as arrays. Trees are fitted on a bounded
sample of labelled documents and sent, as flat arrays, to the tasks that score the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listflow.llm import boosting
from listflow.llm.frames import schema_with
from listflow.llm.textbytes import byte_slices, flat, per_text, text_of, word_hashes, words
from listflow.session import cut_lineage

#: Labelled documents that a fit uses at most; those whose ids hash lowest.
MAX_LABELLED = 20_000

#: Byte classes whose shares are features; every byte is in one class.
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
            "newline": b"\n", "blank": b" \t\r\x0b\x0c", "stop": b".", "comma": b",;:", "loud": b"!", "asking": b"?",
            "bar": b"|", "symbol": b"#*$%&<>~^=+@\\_", "quote": b"'\"`", "bracket": b"()[]{}/-"}
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _k, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _k
_CLASS_OF[128:] = len(_CLASSES) + 1
_N_CLASSES = len(_CLASSES) + 2

FEATURES = (
    [f"share_{k}" for k in _CLASSES] + ["share_other", "share_beyond_ascii"]
    + ["log_bytes", "log_words", "log_lines", "word_bytes", "words_per_line", "distinct_words", "repeated_next",
       "longest_repeat", "single_byte_words", "shouted_words", "symbol_words", "bar_words", "capitals_of_letters",
       "line_ends_closed", "short_lines"])


def document_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``FEATURES`` of each text, one row per text; an empty text has zeros."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    classes = np.bincount(owner * _N_CLASSES + _CLASS_OF[data], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES)
    shares = classes / np.maximum(sizes, 1)[:, None]
    starts, ends, at = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    text = text_of(starts, offsets)
    count = np.maximum(np.diff(at), 1)
    lengths = ends - starts
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    runs = np.diff(np.concatenate([np.flatnonzero(~same), [len(starts)]])) if len(starts) else np.zeros(0, np.int64)
    longest = np.zeros(n)
    np.maximum.at(longest, text[~same], runs)
    # equal words of a text have equal keys; the first place of each is a distinct word
    _, first = np.unique(hashes ^ (text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    distinct = np.bincount(text[first], minlength=n)

    def running(mask: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(mask)])

    kind = _CLASS_OF[data]
    names = list(_CLASSES)
    upper, lower, symbol, bar = (running(kind == names.index(k)) for k in ("upper", "lower", "symbol", "bar"))
    shouted = ((upper[ends] - upper[starts]) >= 2) & ((lower[ends] - lower[starts]) == 0)
    with_symbol = (symbol[ends] - symbol[starts]) > 0
    with_bar = (bar[ends] - bar[starts]) > 0
    breaks = np.flatnonzero(data == 10)
    line_of = running(data == 10)
    last_of_line = np.ones(len(starts), bool)
    last_of_line[:-1] = (line_of[starts[1:]] != line_of[starts[:-1]]) | (text[1:] != text[:-1])
    closed = np.isin(data[ends - 1], np.frombuffer(b".!?:;\"')", np.uint8)) & last_of_line
    filled_lines = np.maximum(per_text(last_of_line, at), 1)
    first_words = np.concatenate([[0], np.flatnonzero(last_of_line)[:-1] + 1]) if len(starts) else np.zeros(0, np.int64)
    in_line = np.flatnonzero(last_of_line) - first_words + 1 if len(starts) else np.zeros(0, np.int64)
    short = np.bincount(text[first_words][in_line < 4], minlength=n) if len(starts) else np.zeros(n)
    lines = np.bincount(text_of(breaks, offsets), minlength=n) + 1
    up, low = classes[:, 0], classes[:, 1]
    rest = np.stack([
        np.log1p(sizes), np.log1p(np.diff(at)), np.log(lines), per_text(lengths, at) / count, count / filled_lines,
        distinct / count, per_text(same, at) / count, np.log1p(longest), per_text(lengths == 1, at) / count,
        per_text(shouted, at) / count, per_text(with_symbol, at) / count, per_text(with_bar, at) / count,
        up / np.maximum(up + low, 1), per_text(closed, at) / filled_lines, short / filled_lines], axis=1)
    out = np.concatenate([shares, rest], axis=1)
    out[sizes == 0] = 0
    return out.astype(np.float32)


def remainder(key: Column, by: int) -> Column:
    """crc32 of the id as text modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % by


def labelled_sample(labels: DataFrame, label: str, learn: Column, key: str = "doc_id", most: int = MAX_LABELLED) -> DataFrame:
    """(key, label) of at most ``most`` labelled ids that ``learn`` allows: those whose md5 is lowest.

    A repeated id counts once, with its larger label; null ids and labels other than 0 and 1 don't count.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & learn)
    once = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_label"))
    return once.orderBy(F.md5(F.col("_key").cast("string")), "_key").limit(most)


def sampled_texts(docs: DataFrame, sample: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_key, _label, _text) of the sample's documents, written to the shared folder.

    The sample is at most ``MAX_LABELLED`` pairs of an id and a label, so it is broadcast and the
    corpus is only read. Documents that share an id keep the text that sorts last.
    """
    found = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return cut_lineage(found.join(F.broadcast(sample), "_key").groupBy("_key").agg(
        F.max("_label").alias("_label"), F.max("_text").alias("_text")), "sample")


def training_rows(sampled: DataFrame, features: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, features, labels) of sampled texts, by id; only feature rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                x = features(*flat(part["_text"]))
                yield pa.RecordBatch.from_arrays(
                    [part["_key"], part["_label"], pa.array([row.tobytes() for row in x], pa.binary())],
                    names=["_key", "_label", "_x"])

    rows = (sampled.select("_key", "_label", "_text").mapInArrow(run, schema_with(sampled, ["_key", "_label"], "_x binary"))
            .toPandas().sort_values("_key"))
    x = np.frombuffer(b"".join(rows["_x"]), np.float32)
    return (rows["_key"].to_numpy(), x.reshape(len(rows), -1) if len(rows) else np.zeros((0, 1), np.float32),
            rows["_label"].to_numpy(np.float64))


def score_texts(docs: DataFrame, scorer: Callable, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with ``scorer`` of its whole texts in ``into``; a column of that name is replaced.

    ``scorer`` takes (bytes, offsets) of many texts and returns one double for each.
    """
    kept = [c for c in docs.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, text):
                score = pa.array(scorer(*flat(part[text])), pa.float64())
                yield pa.RecordBatch.from_arrays(part.columns + [score], names=kept + [into])

    return docs.select(*kept).mapInArrow(run, schema_with(docs, kept, f"`{into}` double"))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", by: int = 5, held: int = 0,
                key: str = "doc_id", text: str = "text") -> boosting.Forest:
    """Trees for ``label`` from labelled rows whose id's remainder modulo ``by`` is not ``held``."""
    sample = labelled_sample(labels, label, remainder(F.col(key), by) != held, key)
    _, x, y = training_rows(sampled_texts(docs, sample, key, text), document_statistics)
    return boosting.fit(x, y)


def score_quality(docs: DataFrame, forest: boosting.Forest, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality in ``into``; null and empty texts are scored as empty."""
    return score_texts(docs, lambda data, offsets: forest.scores(document_statistics(data, offsets)), text, into)
