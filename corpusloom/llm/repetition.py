"""Quality rules: repeated word sequences found with a suffix array, beside plain counts.

The words of a slice of documents form one sequence whose symbols are (document,
word), so no repeat crosses documents. Suffixes are sorted by prefix doubling
(only groups not yet told apart are sorted again); the longest common prefixes
of neighbours, read from the ranks of each doubling, bound the intervals of
maximal repeated substrings. Spans of repeats of at least ``least_words`` words
are united per document.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.texts import map_texts, raw_texts, words_of

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class Limits:
    """Bounds of the rules. A repeat counts from ``least_words`` words on."""

    fewest_words: int = 50
    most_repeated_percent: int = 50
    least_words: int = 8
    most_covered: float = 0.4
    most_longest: int = 100


SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, covered_words bigint, longest_repeat bigint, kept boolean"
)


def quality_rules(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limits: Limits = Limits()
) -> DataFrame:
    """Counts, repeat measures and verdict of every whole text, one row per row of ``docs``.

    A null or empty text has no words: all counts are 0 and it fails the base
    rules. Null ids stay null, repeated rows come out repeated, other columns
    are ignored. One pass, no shuffle; the arrays of a task are bounded by the
    slice size or by its longest single text.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = measure(raw_texts(batch.column(1)), limits)
            return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out.values())], [id_column, *out])

        return work

    return map_texts(docs, [id_column, text_column], text_column, make, f"`{id_column}` {kind}, {SCHEMA}")


def measure(texts: list[bytes | None], limits: Limits) -> dict[str, np.ndarray]:
    words = [words_of(t) for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    bodies = [t or b"" for t in texts]
    chars = [len(t.decode("utf-8", "replace")) - len(t) + len(t.translate(None, SPACES)) for t in bodies]
    symbols = [len(t) - len(t.translate(None, SYMBOLS)) for t in bodies]
    repeat_words, covered, longest = repeats(words, n_words, limits.least_words)
    failed = (n_words < limits.fewest_words) | (100 * repeat_words > limits.most_repeated_percent * n_words)
    good = (covered <= limits.most_covered * n_words) & (longest <= limits.most_longest)
    return {
        "n_words": n_words,
        "word_chars": np.array(chars, np.int64),
        "n_symbols": np.array(symbols, np.int64),
        "n_dup_lines": np.array([repeated_lines(t) for t in bodies], np.int64),
        "n_repeat_words": repeat_words,
        "base_failed": failed,
        "covered_words": covered,
        "longest_repeat": longest,
        "kept": ~failed & good,
    }


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def repeats(
    words: list[list[bytes]], n_words: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: words in repeated 3-word windows, words in repeats of ``least`` words, the longest repeat."""
    n = int(n_words.sum())
    none = np.zeros(len(words), np.int64)
    if n == 0:
        return none, none, none
    flat = np.empty(n, object)
    flat[:] = [w for doc in words for w in doc]
    ids, distinct = pd.factorize(flat)
    doc = np.repeat(np.arange(len(words)), n_words)
    symbol = pd.factorize(doc * len(distinct) + ids)[0]
    windows = longest_matches(symbol, least=3)
    long = np.where(windows >= least, windows, 0)
    ends = np.append(0, np.cumsum(n_words))
    per_doc = lambda flags: np.diff(np.append(0, np.cumsum(flags))[ends])
    best = np.zeros(len(words), np.int64)
    np.maximum.at(best, doc, long)
    return per_doc(cover(np.where(windows >= 3, 3, 0))), per_doc(cover(long)), best


def cover(lengths: np.ndarray) -> np.ndarray:
    """Positions within any of the spans [i, i + lengths[i])."""
    reach = np.maximum.accumulate(np.arange(len(lengths)) + lengths)
    return (reach > np.arange(len(lengths))).astype(np.int64)


def longest_matches(symbol: np.ndarray, least: int) -> np.ndarray:
    """For each position, the longest substring starting there that also starts elsewhere (0 if under ``least``)."""
    n = len(symbol)
    order = np.argsort(symbol, kind="stable")
    rank, levels = np.empty(n + 1, np.int64), []
    rank[n] = -1
    starts = np.append(True, symbol[order][1:] != symbol[order][:-1])
    rank[order] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    step = 1
    while True:
        levels.append(rank.copy())
        open_slots = np.flatnonzero(~(starts & np.append(starts[1:], True)))
        if not len(open_slots):
            break
        at = order[open_slots]
        # The group's place in the order comes first, so groups keep their slots.
        key = rank[at] * (n + 2) + rank[np.minimum(at + step, n)] + 1
        by = np.argsort(key, kind="stable")
        key, at = key[by], at[by]
        order[open_slots] = at
        fresh = np.append(True, key[1:] != key[:-1])
        starts[open_slots] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, open_slots, 0))
        step *= 2
    return neighbour_matches(order, levels, least)


def neighbour_matches(order: np.ndarray, levels: list[np.ndarray], least: int) -> np.ndarray:
    """The greater of the common prefixes with both neighbours in suffix order."""
    n = len(order)
    a, b = order[:-1], order[1:]
    width = np.zeros(n - 1, np.int64)
    # Only neighbours that agree on the largest power of two within ``least`` words can agree on ``least``.
    near = np.arange(n - 1)
    gate = levels[min(least.bit_length() - 1, len(levels) - 1)]
    near = near[gate[a] == gate[b]] if least.bit_length() - 1 < len(levels) else near[:0]
    a, b, got = a[near], b[near], np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = np.minimum(a + got, n), np.minimum(b + got, n)
        same = (levels[k][x] == levels[k][y]) & (x < n) & (y < n)
        got += same.astype(np.int64) << k
    width[near] = np.where(got >= least, got, 0)
    out = np.zeros(n, np.int64)
    np.maximum.at(out, order[:-1], width)
    np.maximum.at(out, order[1:], width)
    return out
