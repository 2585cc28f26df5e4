"""Token counts of whole texts by rank-synchronous array merging.

A text is split into pre-tokens; the different ones of a batch are held as one ragged numpy array of
symbols. In each round every sequence applies its own lowest-ranked pair, at all its places at once,
until no pair of any sequence is in the merge list; what counts is the number of symbols left.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from listflow.llm.frames import schema_with
from listflow.llm.textbytes import byte_slices

# Fixed value: the pattern that splits a text before the merges of the byte-level vocabulary.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters of text in one block, and pre-tokens whose counts a process keeps for later batches.
BLOCK_CHARS = 1 << 20
MOST_KNOWN = 500_000
#: Longer pre-tokens are counted anew each time they occur.
LONGEST_KNOWN = 64

_NEVER = np.int64(2**31)
_SPLIT = regex.compile(SPLIT_PATTERN)
_BEFORE_SPACE = regex.compile(r"\S(?=\s)")

_LOADED: dict[str, "Vocabulary"] = {}


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in prints else next(spare)) for b in range(256)]


def _unsettled() -> re.Pattern:
    """Characters whose class depends on the Unicode version: letters, digits or spaces that this Python doesn't know."""
    unknown = "".join(chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn")
    at = np.array([ord(c) for c in regex.findall(r"[\p{L}\p{N}\s]", unknown)], np.int64)
    runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)
    return re.compile("[" + "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in runs if len(r)) + "]")


class Vocabulary:
    """A byte-level BPE vocabulary as arrays: the ranks and results of its pairs, and known counts."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                               "byte_fallback", "ignore_merges"))
        if (model["type"], splitter.get("type"), splitter.get("use_regex")) != ("BPE", "ByteLevel", True) or not plain \
                or splitter.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        ids = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = np.append(keys[order], np.int64(2**62)), np.append(order, _NEVER), made[order]
        self.of_byte = np.array([ids[c] for c in byte_alphabet()], np.int64)
        first = self.of_byte
        self.byte_pairs = self.places(np.repeat(first, 256), np.tile(first, 256))
        added = [t["content"] for t in spec["added_tokens"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that change their surroundings")
        self.added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.unsettled = _unsettled()
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.known: dict[str, int] = {}

    def places(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where each pair stands in the merge list's arrays; the end for a pair that isn't in it."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, at, len(self.keys) - 1)

    def symbols_left(self, tokens: list[bytes]) -> np.ndarray:
        """How many symbols each byte sequence has after all merges."""
        sizes = np.array([len(t) for t in tokens], np.int64)
        out = sizes.copy()
        data = np.frombuffer(b"".join(tokens), np.uint8).astype(np.int64)
        seq = np.repeat(np.arange(len(tokens)), sizes)
        ids = self.of_byte[data]
        last = len(self.keys) - 1
        place = np.full(len(ids), last)
        if len(ids) > 1:
            place[:-1] = np.where(seq[1:] == seq[:-1], self.byte_pairs[data[:-1] * 256 + data[1:]], last)
        while len(ids):
            rank = self.ranks[place]
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            lengths = np.diff(np.append(starts, len(seq)))
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == _NEVER
            if done.any():
                out[seq[starts[done]]] = lengths[done]
                on = np.repeat(~done, lengths)
                ids, seq, place, rank = ids[on], seq[on], place[on], rank[on]
                lengths, lowest = lengths[~done], lowest[~done]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, lengths))
            # equal symbols in a row: every second pair, from the left
            fresh = np.append(True, hit[1:] != hit[:-1] + 1)
            count = np.arange(len(hit))
            hit = hit[(count - np.maximum.accumulate(np.where(fresh, count, 0))) % 2 == 0]
            ids[hit] = self.made[place[hit]]
            stay = np.ones(len(ids), bool)
            stay[hit + 1] = False
            at = hit - np.arange(len(hit))
            ids, seq, place = ids[stay], seq[stay], place[stay]
            changed = np.concatenate([at, at[at > 0] - 1])
            inside = changed[changed < len(ids) - 1]
            place[changed] = last
            inside = inside[seq[inside] == seq[inside + 1]]
            place[inside] = self.places(ids[inside], ids[inside + 1])
        return out

    def pre_tokens(self, text: str) -> list[str]:
        if not text.isascii() and self.unsettled.search(text):
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return _SPLIT.findall(text)

    def _blocks(self, text: str) -> Iterator[str]:
        """The text in blocks that end where a pre-token surely ends: before white space, after another character."""
        start = 0
        while len(text) - start > BLOCK_CHARS:
            cut = _BEFORE_SPACE.search(text, start + BLOCK_CHARS)
            if cut is None:
                break
            yield text[start:cut.end()]
            start = cut.end()
        yield text[start:] if start else text

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text; an added token's string is one token."""
        out = np.zeros(len(texts), np.int64)
        held: list[tuple[int, list[str]]] = []
        size = 0
        for row, text in enumerate(texts):
            spans = [text]
            if self.added is not None:
                spans = self.added.split(text)
                out[row] = len(spans) - 1
            for block in (b for span in spans for b in self._blocks(span)):
                held.append((row, self.pre_tokens(block)))
                size += len(block)
                if size >= BLOCK_CHARS:
                    self._add(held, out)
                    held, size = [], 0
        self._add(held, out)
        return out

    def _add(self, held: list[tuple[int, list[str]]], out: np.ndarray) -> None:
        known = self.known
        if len(known) > MOST_KNOWN:
            known.clear()
        new = sorted(set().union(*(tokens for _, tokens in held)).difference(known))
        made = dict(zip(new, self.symbols_left([t.encode() for t in new]).tolist())) if new else {}
        known.update(made)
        for row, tokens in held:
            out[row] += sum(map(known.__getitem__, tokens))
        for token in new:
            if len(token) > LONGEST_KNOWN:
                del known[token]


def vocabulary_at(path: str) -> Vocabulary:
    """The vocabulary, read once per process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, text: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, unless named) with n_bytes, n_tokens and over_limit (n_tokens > ``limit``).

    ``vocabulary`` is a byte-level BPE vocabulary in JSON at a path that every executor can read; the
    counts are those of ``tokenizers`` for it without begin, end or padding. A null text counts as
    empty, with no token; texts are read whole, of any length; repeated rows stay; an empty table
    gives an empty one. Columns of the three names are replaced.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("n_bytes", "n_tokens", "over_limit")]
    schema = schema_with(docs, names, "n_bytes long, n_tokens long, over_limit boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary_at(vocabulary)
        for batch in batches:
            for part in byte_slices(batch, text):
                n = own.counts([t or "" for t in part[text].to_pylist()])
                size = pc.fill_null(pc.binary_length(part[text]), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in names), size, pa.array(n), pa.array(n > limit)],
                    names=[*names, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(*dict.fromkeys([*(f"`{c}`" for c in names), f"`{text}`"])).mapInArrow(run, schema)
