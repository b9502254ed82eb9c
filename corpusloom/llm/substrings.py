"""Substring deduplication by recompression.

The word sequence of every document is compressed in rounds. A round names
runs of one symbol, or pairs of neighbours of which a hash puts the first into
a left and the second into a right half of the alphabet. A name is a hash of
what it stands for, so all tasks give equal strings equal names without a
dictionary to share. Whether two symbols merge depends on the two alone, so
equal stretches of text get equal symbols except at their borders, and the
rounds tell for each window which of its symbols are certain whatever stands
around it.

A window can only repeat if its certain symbols do. One shuffle counts the
symbols of the last round; windows whose certain symbols all repeat are named
by a 128-bit polynomial over their words and counted in a second shuffle, which
verifies them. Names travel sorted and packed, once per chunk of documents, and
come back as one bit each; the text is dealt into chunks once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.texts import raw_texts, words_of

# Fixed value of the contract: words of a window.
WINDOW = 35
# Rounds: the first names runs of words, the others pairs.
ROUNDS = 7
# Bytes of text in a chunk, and of text for one bucket of names.
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 24 << 20

ODD_1, ODD_2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (xor-shifts and odd factors)."""
    x = (x ^ (x >> U64(32))) * U64(ODD_2)
    x = (x ^ (x >> U64(29))) * U64(ODD_1)
    return x ^ (x >> U64(32))


@dataclass
class Words:
    """The words of a chunk in one sequence."""

    lists: list[list[bytes]]
    ends: np.ndarray
    names: np.ndarray
    doc: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes | None]) -> Words:
        from xxhash import xxh64_intdigest

        lists = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in lists], np.int64)
        flat = pa.array([w for doc in lists for w in doc], pa.binary()).dictionary_encode()
        known = np.array([xxh64_intdigest(w) for w in flat.dictionary.to_pylist()], U64)
        codes = np.asarray(flat.indices)
        names = known[codes] if len(codes) else np.zeros(0, U64)
        return cls(lists, np.cumsum(sizes), names, np.repeat(np.arange(len(lists)), sizes))


@dataclass
class Parse:
    """The last round's symbols, and for each word position the certain symbols of the window that starts there."""

    names: np.ndarray
    first: np.ndarray
    last: np.ndarray


def recompress(words: Words, window: int, rounds: int) -> Parse:
    """``first`` and ``last`` bound the certain symbols of each window (last exclusive); empty where first >= last."""
    n = len(words.names)
    names, doc = words.names, words.doc
    first = np.arange(n)
    last = np.minimum(first + window, n)
    for turn in range(rounds):
        m = len(names)
        if m == 0:
            break
        if turn == 0:
            starts = np.append(True, (names[1:] != names[:-1]) | (doc[1:] != doc[:-1]))
            run = np.cumsum(starts) - 1
            begins = np.append(np.flatnonzero(starts), m)
            # The run at either border may go on outside of the window.
            first = begins[run[np.minimum(first, m - 1)] + 1]
            last = begins[run[np.maximum(last - 1, 0)]]
            lengths = np.diff(begins).astype(U64)
            merged = mix(names[starts] + U64(ODD_1) * lengths)
            new = np.where(lengths > 1, merged, names[starts])
            keep = starts
        else:
            left = (mix(names + U64(turn * ODD_2 & (1 << 64) - 1)) & U64(1)).astype(bool)
            joins = np.append(left[:-1] & ~left[1:] & (doc[1:] == doc[:-1]), False)
            # A right symbol at the start, or a left one at the end, may belong to a pair with what stands outside.
            start = np.minimum(first, m - 1)
            first = first + ((first < m) & ~left[start])
            last = last - ((last > 0) & left[np.maximum(last - 1, 0)])
            after = np.append(names[1:], U64(0))
            new = np.where(joins, mix(names * U64(ODD_1) + mix(after + U64(turn))), names)
            keep = np.append(True, ~joins[:-1])
            new = new[keep]
        place = np.append(0, np.cumsum(keep))
        first, last = place[np.minimum(first, m)], place[np.minimum(last, m)]
        names, doc = new, doc[keep]
    return Parse(names, first, last)


def window_keys(names: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit polynomial names of the windows that start at the positions."""
    out = []
    for base, values in ((ODD_1, names), (ODD_2, mix(names + U64(1)))):
        n = len(values)
        powers = np.full(n + 1, base, U64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        back = np.full(n + 1, pow(base, -1, 1 << 64), U64)
        back[0] = 1
        back = np.multiply.accumulate(back)
        sums = np.append(U64(0), np.cumsum(values * powers[:n], dtype=U64))
        out.append(mix((sums[at + window] - sums[at]) * back[at]))
    return out[0], out[1]


@dataclass
class Names:
    """Distinct names of a chunk in order: where they occur, and whether they occur twice in the chunk."""

    keys: np.ndarray  # one or two columns of uint64
    inverse: np.ndarray
    twice: np.ndarray

    @classmethod
    def of(cls, *columns: np.ndarray) -> Names:
        order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
        table = np.stack([c[order] for c in columns], axis=1) if len(order) else np.zeros((0, len(columns)), U64)
        fresh = np.append(True, (table[1:] != table[:-1]).any(axis=1))[: len(order)]
        group = np.cumsum(fresh) - 1
        inverse = np.empty(len(order), np.int64)
        inverse[order] = group
        return cls(table[fresh], inverse, np.bincount(group, minlength=int(fresh.sum())) > 1)

    def bounds(self, buckets: int) -> np.ndarray:
        """Where each bucket's names start; buckets are ranges of the first column."""
        place = ((self.keys[:, 0] >> U64(32)) * U64(buckets)) >> U64(32)
        return np.searchsorted(place, np.arange(buckets + 1, dtype=U64))

    def packed(self, chunk: int, buckets: int) -> pa.Table:
        bounds = self.bounds(buckets)
        full = np.flatnonzero(np.diff(bounds))
        spans = [(bounds[b], bounds[b + 1]) for b in full]
        return pa.table(
            {
                "bucket": pa.array(full, pa.int32()),
                "chunk": pa.array(np.full(len(full), chunk), pa.int32()),
                "names": pa.array([self.keys[a:b].tobytes() for a, b in spans], pa.binary()),
                "twice": pa.array([np.packbits(self.twice[a:b]).tobytes() for a, b in spans], pa.binary()),
            }
        )

    def shared(self, bits: dict[int, bytes], buckets: int) -> np.ndarray:
        """The bits that came back, per occurrence."""
        bounds, out = self.bounds(buckets), np.zeros(len(self.keys), bool)
        for bucket, packed in bits.items():
            a, b = bounds[bucket], bounds[bucket + 1]
            out[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a)
        return out[self.inverse]


PACKED = "bucket int, chunk int, names binary, twice binary"
BITS = "bucket int, chunk int, bits binary"


def count_names(width: int) -> Callable[[pa.Table], pa.Table]:
    """For the names of one bucket from all chunks: which occur more than once."""

    def count(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, U64).reshape(-1, width) for x in table["names"].to_pylist()]
        twice = [
            np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)).astype(bool)
            for x, p in zip(table["twice"].to_pylist(), parts, strict=True)
        ]
        every = np.concatenate(parts)
        names = Names.of(*[every[:, c] for c in range(width)])
        more = names.twice.copy()
        more[names.inverse[np.concatenate(twice)]] = True
        flags, at, bits = more[names.inverse], 0, []
        for part in parts:
            bits.append(np.packbits(flags[at : at + len(part)]).tobytes())
            at += len(part)
        return pa.table({"bucket": table["bucket"], "chunk": table["chunk"], "bits": pa.array(bits, pa.binary())})

    return count


def bits_of(table: pa.Table, kind: int) -> dict[int, bytes]:
    rows = zip(table["bucket"].to_pylist(), table["bits"].to_pylist(), table["kind"].to_pylist(), strict=True)
    return {bucket: bits for bucket, bits, k in rows if k == kind}


def candidates(words: Words, parse: Parse, symbols: Names, bits: dict[int, bytes], buckets: int, window: int) -> np.ndarray:
    """Starts of the windows whose certain symbols all repeat, or that have none."""
    n = len(words.names)
    ends = words.ends[words.doc] if n else np.zeros(0, np.int64)
    alone = np.append(0, np.cumsum(~symbols.shared(bits, buckets)))
    possible = (parse.first >= parse.last) | (alone[np.maximum(parse.first, parse.last)] == alone[parse.first])
    return np.flatnonzero((np.arange(n) + window <= ends) & possible)


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    rounds: int = ROUNDS,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``id, n_words, n_removed, kept``: each whole text without the words of windows that also start elsewhere.

    A window of ``window`` consecutive words of a document is repeated if its
    word sequence starts at another place, in the same or another row; windows
    are judged on the input. ``kept`` has the other words, joined by one space.
    Null and empty texts have no words; texts shorter than a window keep all.
    One row per row of ``docs``; null and repeated ids are no matter, as nothing
    is joined by id. Other columns are ignored.

    Chunks are of bounded size but for a longer single text, buckets of names
    are ranges of hashes with one packed list per chunk, so neither grows with
    how often a passage is repeated.
    """
    size = docs.agg(F.sum(F.octet_length(text_column).cast("long"))).first()[0] or 0
    chunks, buckets = max(1, -(-size // chunk_bytes)), max(1, -(-size // bucket_bytes))
    kind = docs.schema[id_column].dataType.simpleString()
    chunk = F.pmod(F.xxhash64(F.col(text_column), F.col(id_column)), F.lit(chunks)).cast("int")
    dealt = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), chunk.alias("chunk"))

    def symbols_of(table: pa.Table) -> pa.Table:
        words = Words.of(raw_texts(table["text"].combine_chunks()))
        names = Names.of(recompress(words, window, rounds).names)
        return names.packed(table["chunk"][0].as_py(), buckets)

    def windows(words: Words, bits: pa.Table) -> tuple[np.ndarray, Names]:
        parse = recompress(words, window, rounds)
        at = candidates(words, parse, Names.of(parse.names), bits_of(bits, 0), buckets, window)
        return at, Names.of(*window_keys(words.names, at, window))

    def windows_of(table: pa.Table, bits: pa.Table) -> pa.Table:
        words = Words.of(raw_texts(table["text"].combine_chunks()))
        return windows(words, bits)[1].packed(table["chunk"][0].as_py(), buckets)

    def removed(table: pa.Table, bits: pa.Table) -> pa.Table:
        words = Words.of(raw_texts(table["text"].combine_chunks()))
        at, keys = windows(words, bits)
        n = len(words.names)
        reach = np.zeros(n, np.int64)
        repeated = at[keys.shared(bits_of(bits, 1), buckets)]
        reach[repeated] = repeated + window
        gone = np.maximum.accumulate(reach) > np.arange(n) if n else np.zeros(0, bool)
        counts, kept, begin = [], [], 0
        for doc, end in zip(words.lists, words.ends.tolist(), strict=True):
            flags = gone[begin:end]
            counts.append(int(flags.sum()))
            kept.append(b" ".join(doc if not counts[-1] else [doc[i] for i in np.flatnonzero(~flags)]).decode())
            begin = end
        return pa.table(
            {
                "id": table["id"],
                "n_words": pa.array([len(doc) for doc in words.lists], pa.int64()),
                "n_removed": pa.array(counts, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )

    by_chunk = dealt.groupBy("chunk")
    symbol_bits = by_chunk.applyInArrow(symbols_of, PACKED).groupBy("bucket").applyInArrow(count_names(1), BITS)
    symbol_bits = symbol_bits.withColumn("kind", F.lit(0))
    window_rows = by_chunk.cogroup(symbol_bits.groupBy("chunk")).applyInArrow(windows_of, PACKED)
    window_bits = window_rows.groupBy("bucket").applyInArrow(count_names(2), BITS).withColumn("kind", F.lit(1))
    answers = symbol_bits.unionByName(window_bits)
    out = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(
        removed, f"id {kind}, n_words bigint, n_removed bigint, kept string"
    )
    return out.withColumnRenamed("id", id_column)
