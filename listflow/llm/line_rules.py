"""Quality rules, lines first: failing lines go, then documents that lose too much.

Every line with a word is held against rules for punctuation, navigation, boilerplate, symbols,
shouting and repetition. What is left is the cleaned text. A document is rejected if its base
statistics fail or if it loses more than half of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from listflow.llm.frames import schema_with
from listflow.llm.textbytes import byte_slices

# Signs between menu entries, signs that end a sentence, and phrases of page furniture.
SEPARATORS = "|»›•·→"
CLOSERS = ".!?…:;,\"'”’»)]"
BOILERPLATE = (
    r"all rights reserved|copyright ©|©|cookie (?:policy|settings)|accept (?:all )?cookies|enable javascript|"
    r"javascript is disabled|privacy policy|terms of (?:use|service)|sign (?:in|up)|log ?in|subscribe (?:now|to)|"
    r"share this|read more|click here|back to top|skip to (?:main )?content|(?:licensed|released) under|"
    r"is licensed under|lorem ipsum|powered by|advertisement")
SYMBOLS = "#*$%&|<>"

#: A line of boilerplate has at most so many words; an unfinished one fails below so many.
BOILERPLATE_WORDS, UNFINISHED_WORDS = 20, 8
#: Fewer words fail a document's base, and so does a larger share (per cent) of repeated words.
LEAST_WORDS, MOST_REPEATED = 10, 20

_WORD = regex.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = regex.compile("[" + regex.escape(SYMBOLS) + "]")
_SEPARATOR = regex.compile("[" + regex.escape(SEPARATORS) + "]")
#: The phrases as whole words; the sign needs no border.
_BOILERPLATE = regex.compile(rf"(?<![\p{{L}}\p{{N}}_])(?:{BOILERPLATE})(?![\p{{L}}\p{{N}}_])|©", regex.IGNORECASE)
_LOWER, _UPPER = regex.compile(r"\p{Ll}"), regex.compile(r"\p{Lu}")
_CLOSERS = tuple(CLOSERS)


def line_fails(line: str, words: list[str]) -> bool:
    """Whether a line with these words fails a rule.

    Navigation: a separator for every five words. Punctuation: short without a closing sign.
    Boilerplate: short with one of the phrases. Symbols: one for every two words. Shouting: three
    words or more, six capitals or more and no small letter. Repetition: ten words or more, a
    third of them distinct at most.
    """
    n = len(words)
    separators = len(_SEPARATOR.findall(line))
    if separators and 5 * separators >= n:
        return True
    if n < UNFINISHED_WORDS and not words[-1].endswith(_CLOSERS):
        return True
    if n <= BOILERPLATE_WORDS and _BOILERPLATE.search(line):
        return True
    if 2 * len(_SYMBOL.findall(line)) >= n:
        return True
    if n >= 3 and not _LOWER.search(line) and len(_UPPER.findall(line)) >= 6:
        return True
    return n >= 10 and 3 * len(set(words)) <= n


def repeated_words(words: list[str], width: int = 5) -> int:
    """Words that lie in a run of ``width`` words which the text has twice or more."""
    if len(words) <= width:
        return 0
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    # a run's number is found from those of shorter runs, so equal numbers mean equal runs
    runs, size = ids, 1
    while size < width:
        step = min(size, width - size)
        pairs = runs[:len(runs) - step] * (runs.max() + 1) + runs[step:]
        _, runs, count = np.unique(pairs, return_inverse=True, return_counts=True)
        size += step
    twice = count[runs] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:len(twice)] += twice
    edges[width:] -= twice
    return int((np.cumsum(edges)[:-1] > 0).sum())


def judged(text: str) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines,
    n_failed_lines, lost_words, cleaned text) of one whole text."""
    n = chars = lost = failed = 0
    every: list[str] = []
    filled, good = [], []
    for line in text.split("\n"):
        words = _WORD.findall(line)
        if not words:
            good.append(line)
            continue
        filled.append(line)
        every += words
        if line_fails(line, words):
            failed += 1
            lost += len(words)
        else:
            good.append(line)
    n, chars = len(every), sum(map(len, every))
    repeated = repeated_words(every)
    base_failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
    kept = not base_failed and 2 * lost <= n
    return (n, chars, len(_SYMBOL.findall(text)), len(filled) - len(set(filled)), repeated, base_failed, kept,
            len(filled), failed, lost, "\n".join(good))


MADE = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
        "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(), "n_lines": pa.int64(),
        "n_failed_lines": pa.int64(), "lost_words": pa.int64(), "cleaned": pa.string()}
_SQL_TYPES = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string"}


def line_first(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics and verdict of ``judged`` for each whole text (null: empty).

    Columns named like one of ``MADE`` are replaced. Each row is judged on its own, so there is no
    shuffle; an empty text fails its base.
    """
    kept = [c for c in docs.columns if c not in MADE]
    made = ", ".join(f"{c} {_SQL_TYPES[t]}" for c, t in MADE.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, text):
                rows = [judged(t or "") for t in part[text].to_pylist()]
                columns = list(zip(*rows)) if rows else [()] * len(MADE)
                yield pa.RecordBatch.from_arrays(
                    part.columns + [pa.array(c, t) for c, t in zip(columns, MADE.values())], names=kept + list(MADE))

    return docs.select(*kept).mapInArrow(run, schema_with(docs, kept, made))
