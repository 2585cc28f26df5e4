"""Packing token sequences: first-fit decreasing on a tournament tree, in randomised groups.

Documents are tokenised once and cut into pieces. Only the pieces' lengths are shuffled, to groups
of bounded size drawn at random; each group is packed on its own.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listflow.llm.frames import fresh, schema_with
from listflow.llm.textbytes import byte_slices
from listflow.session import cut_lineage

#: Pieces in a group on average; a group's rows are all that one task holds.
GROUP_PIECES = 8192

# Fixed value: the pattern that splits a text before the merges of the byte-level vocabulary.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Fixed value: the special token of the vocabulary; in a text it is one id.
SPECIAL = "<|endoftext|>"
#: White space in a row from which texts go to ``tokenizers``; the rank file's reader fails on a million.
LONG_BLANK = 100_000
_BLANK = re.compile(r"\s\s+")

_LOADED: dict[str, object] = {}


def _needs_tokenizers(text: str) -> bool:
    """Whether the rank file's reader gives other ids for a text, or none."""
    return SPECIAL in text or len(text) >= LONG_BLANK and any(
        m.end() - m.start() >= LONG_BLANK for m in _BLANK.finditer(text))


def encoder(path: str):
    """A function from texts to lists of ids for the vocabulary at ``path``, loaded once per process.

    ``.json`` is read by ``tokenizers``, whose ids count. ``.tiktoken`` holds the ranks of the same
    byte-level merges, several times faster; texts with the special token or with very long white
    space are left to the ``.json`` of the same name, which must stand beside it for them.
    """
    if path not in _LOADED:
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            _LOADED[path] = lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        else:
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            encoding = tiktoken.Encoding(path, pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
            exact = re.sub(r"\.tiktoken$", "", path) + ".json"
            _LOADED[path] = lambda texts: [
                encoder(exact)([t])[0] if _needs_tokenizers(t) else encoding.encode_ordinary(t) for t in texts]
    return _LOADED[path]


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 2048, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One row per piece: ``key``, start, length, ids (little-endian unsigned 32-bit) and doc_tokens.

    A document is the ids of its whole text (null: empty) and ``end_id``, cut at every ``capacity``
    ids. ``vocabulary`` is a path that every executor can read.
    """
    schema = schema_with(docs, [key], "start long, length long, ids binary, doc_tokens long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for part in byte_slices(batch, text):
                rows = []
                for name, ids in zip(part[key].to_pylist(), encode([t or "" for t in part[text].to_pylist()])):
                    whole = np.array(ids + [end_id], "<u4")
                    rows += [(name, at, min(capacity, len(whole) - at), whole[at:at + capacity].tobytes(), len(whole))
                             for at in range(0, len(whole), capacity)]
                columns = list(zip(*rows)) if rows else [()] * 5
                kinds = [part[key].type, pa.int64(), pa.int64(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=[key, "start", "length", "ids", "doc_tokens"])

    return docs.select(key, text).mapInArrow(run, schema)


def first_fit(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each length, taken in the given order: the first with room, found in a tournament tree.

    A node holds the most room of any bin below it; descending to the left whenever there is enough
    finds the first bin that fits.
    """
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins = []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        room[node] -= length
        node //= 2
        while node:
            left, right = room[2 * node], room[2 * node + 1]
            best = left if left > right else right
            if room[node] == best:
                break
            room[node] = best
            node //= 2
    return bins


def pack(pieces: DataFrame, capacity: int = 2048, group_pieces: int = GROUP_PIECES, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: where each piece stands, without gaps in a sequence.

    Rows are written once with a number each, so equal rows and a hot id spread over the groups
    like others; groups are drawn by a hash of that number, as many as keep ``group_pieces`` on
    average. Within a group, pieces go longest first to the first sequence with room. A piece
    longer than ``capacity`` is an error. Columns of the two names are replaced.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    row, group = fresh(pieces, "_row"), fresh(pieces, "_group")
    numbered = cut_lineage(pieces.select(*kept).withColumn(row, F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-numbered.count() // group_pieces))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([length, row], ascending=[False, True], kind="stable")
        sizes = rows[length].to_numpy()
        if len(sizes) and sizes[0] > capacity:
            raise ValueError(f"a piece of {sizes[0]} does not fit into {capacity}")
        bins = np.array(first_fit(sizes.tolist(), capacity), np.int64)
        order = np.argsort(bins, kind="stable")
        before = np.concatenate([[0], np.cumsum(sizes[order])[:-1]]) if len(order) else np.zeros(0, np.int64)
        first = np.ones(len(order), bool)
        first[1:] = bins[order][1:] != bins[order][:-1]
        base = np.maximum.accumulate(np.where(first, before, 0)) if len(order) else before
        offset = np.empty(len(order), np.int64)
        offset[order] = before - base
        return rows.assign(sequence_id=rows[group].to_numpy() * 2**32 + bins, offset=offset)[kept + ["sequence_id", "offset"]]

    grouped = numbered.withColumn(group, F.pmod(F.xxhash64(row), F.lit(groups)))
    return grouped.groupBy(group).applyInPandas(run, schema_with(numbered, kept, "sequence_id long, offset long"))
