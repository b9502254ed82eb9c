"""Words matched with a trie of terms within an edit distance.

The trie is walked once for a whole block of words. A node keeps one row of the
edit-distance table for every word still in reach: row ``j`` is the distance
between the node's prefix and the word's first ``j`` characters. A word leaves
a branch when no entry of its row is within its bound, and its bound sinks to
the best distance found so far.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Terms in one trie and words in one block: what a task holds.
TRIE_TERMS = 65_536
BLOCK_WORDS = 16_384


class TermTrie:
    """Terms by their characters; a node is (children by character, number of the term that ends there)."""

    def __init__(self, terms: list[str]) -> None:
        self.root: tuple[dict, list] = ({}, [])
        for number, term in enumerate(terms):
            node = self.root
            for c in term:
                node = node[0].setdefault(ord(c), ({}, []))
            node[1].append(number)

    def nearest(self, words: list[str], most: int) -> tuple[np.ndarray, np.ndarray]:
        """Distance and number of each word's nearest term (the least number of those); ``most + 1`` and -1 if none is near."""
        n, width = len(words), max(map(len, words), default=0)
        letters = np.zeros((n, width), np.uint32)
        for i, word in enumerate(words):
            letters[i, : len(word)] = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(w) for w in words], np.int64)
        best, which = np.full(n, most + 1, np.int64), np.full(n, -1, np.int64)
        steps = np.arange(width + 1)
        pending = [(self.root, np.arange(n), np.tile(steps, (n, 1)))]
        while pending:
            (children, ends), alive, rows = pending.pop()
            for number in ends:
                far = rows[np.arange(len(alive)), sizes[alive]]
                closer = (far < best[alive]) | (far == best[alive]) & (far <= most) & (number < which[alive])
                best[alive[closer]], which[alive[closer]] = far[closer], number
            for letter, child in children.items():
                there = rows.min(axis=1) <= np.minimum(best[alive], most)
                if not there.all():
                    alive, rows = alive[there], rows[there]
                if not len(alive):
                    break
                changed = np.empty_like(rows)
                changed[:, 0] = rows[:, 0] + 1
                changed[:, 1:] = np.minimum(rows[:, 1:] + 1, rows[:, :-1] + (letters[alive] != letter))
                # An insertion costs one more than what stands before it: a running minimum once the slope is taken off.
                changed = np.minimum.accumulate(changed - steps, axis=1) + steps
                near = changed.min(axis=1) <= np.minimum(best[alive], most)
                if near.any():
                    pending.append((child, alive[near], changed[near]))
        return best, which


def nearest_terms(words: DataFrame, terms: DataFrame, most: int, trie_terms: int = TRIE_TERMS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, nearest, distance`` of the distinct ``word`` rows that have a term within ``most`` edits.

    ``terms`` has ``term`` and the ``nearest`` to report for it. Terms are
    dealt into tries by length and, where a length has many, by hash; a word
    meets the tries of the lengths that it can be near to. Ties go to the
    smaller ``nearest``.
    """
    terms = terms.withColumn("size", F.length("term"))
    size = F.length("word")
    met = words.select("word", F.explode(F.sequence(F.greatest(size - most, F.lit(0)), size + most)).alias("size"))

    def shares(df: DataFrame, held: int, name: str) -> DataFrame:
        return df.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / F.lit(held)).cast("int").alias(name))

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    # One row per length of term.
    cut = shares(terms, trie_terms, "tries").join(shares(met, block_words, "blocks"), "size")
    met = met.join(cut, "size").select("word", "size", each("tries").alias("part"), F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int").alias("block"))
    dealt = terms.join(cut, "size").select("term", "nearest", "size", F.pmod(F.xxhash64("term"), F.col("tries")).cast("int").alias("part"), each("blocks").alias("block"))

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[str, str, int]] = []
        if left.num_rows and right.num_rows:
            right = right.sort_by("nearest")
            asked, names = left.column("word").to_pylist(), right.column("nearest").to_pylist()
            best, which = TermTrie(right.column("term").to_pylist()).nearest(asked, most)
            found = [(asked[i], names[which[i]], int(best[i])) for i in np.flatnonzero(which >= 0)]
        word, nearest, distance = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"word": pa.array(word, pa.string()), "nearest": pa.array(nearest, pa.string()), "distance": pa.array(distance, pa.int32())})

    keys = ["size", "part", "block"]
    hits = met.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(match, "word string, nearest string, distance int")
    return hits.groupBy("word").agg(F.min(F.struct("distance", "nearest")).alias("b")).select("word", "b.nearest", "b.distance")
