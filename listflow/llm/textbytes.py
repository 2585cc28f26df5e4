"""Words and hashes of many texts at once, read straight from Arrow string buffers.

A batch of texts is one byte array with an offset per text; all helpers work on that form, so
the cost per text is a few array operations. White space is ``[\\x20\\x09-\\x0D]`` throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 2**64)


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``limit`` bytes; a longer text is a run of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    texts = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets per text); no word crosses a text's border."""
    space = SPACE[data]
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    filled = offsets[1:] > offsets[:-1]
    before[offsets[:-1][filled]] = True
    after[offsets[1:][filled] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hasher:
    """64-bit hashes of any spans of one byte array, the same wherever a span stands."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        powers = np.full(n + 1, _MULTIPLIER, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=self._sums[1:])
        powers[:] = _INVERSE
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self._back = powers

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        own = (self._sums[ends] - self._sums[starts]) * self._back[starts]
        return mixed(own + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word."""
    return Hasher(data).spans(starts, ends)


def prefix_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Where the first ``length`` code points of each word end; the start itself in a shorter word."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    after = np.searchsorted(heads, starts) + length
    bounded = np.append(heads, [len(data), len(data) + 1])[np.minimum(after, len(heads) + 1)]
    return np.where(bounded <= ends, bounded, starts)


def text_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of the text that each position lies in."""
    return np.searchsorted(offsets, starts, side="right") - 1


def per_text(values: np.ndarray, word_offsets: np.ndarray) -> np.ndarray:
    """Sums of a per-word array by text."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[word_offsets[1:]] - total[word_offsets[:-1]]
