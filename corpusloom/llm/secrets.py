"""Secret scan: fixed patterns, and strings that a tokenizer vocabulary compresses badly.

Words of any language are made of vocabulary entries several characters long;
random strings fall apart into entries of one or two. A run of key characters
whose characters per token stay under a bound is reported as ``random`` unless
it is a known digest or an identifier.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.texts import map_texts
from corpusloom.llm.vocabulary import DEFAULT_PATH, encoding, read_ranks

# The patterns of the base kinds and the least lengths of what they match.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 20
HEX = r"[0-9a-f]+"
HEX_LEAST = 24
KINDS = ("assign", "access", "hex", "random")

# Runs that a key could be, and the digests (by length in hexadecimal) and identifiers among them.
RUN = r"[A-Za-z0-9+/_=-]{20,}"
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
DIGEST = r"[0-9a-f]+|[0-9A-F]+"
IDENTIFIER = r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[0-9+/_=-]+|[A-Za-z+/_=-]+|[A-Za-z]+[0-9]*(?:[-_/=][A-Za-z]*[0-9]*)*+"
MOST_CHARS_PER_TOKEN = 2.0


def scan_spans(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_chars_per_token: float = MOST_CHARS_PER_TOKEN,
    vocabulary: str = DEFAULT_PATH,
) -> DataFrame:
    """``id, spans`` with every span (kind, start, end, in code points, end exclusive) of the whole text, one row per row.

    A null text counts as empty and has no spans. Repeated rows come out
    repeated; null ids stay null. Other columns of ``docs`` are ignored. The
    scan is one pass without a shuffle, so no key can be hot; a text is held
    whole in one task.
    """
    ranks = read_ranks(vocabulary)
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        find = finder(ranks, most_chars_per_token)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, b, k in find(text or "")]
                for text in batch.column(1).to_pylist()
            ]
            spans = pa.array(found, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
            return pa.RecordBatch.from_arrays([batch.column(0), spans], [id_column, "spans"])

        return work

    return map_texts(docs, [id_column, text_column], text_column, make, schema)


def finder(ranks: bytes, most_chars_per_token: float) -> Callable[[str], list[tuple[int, int, int]]]:
    """A function that lists the (start, end, kind number) of one text, by start, then kind."""
    tokens = encoding(ranks)
    assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
    # A maximal run is long enough or not, so the bound may stand in the pattern.
    access = re.compile(f"{ACCESS[:-1]}{{{ACCESS_LEAST - 4},}}")
    hexes = re.compile(f"{HEX[:-1]}{{{HEX_LEAST},}}")
    run, digest, identifier = re.compile(RUN), re.compile(DIGEST), re.compile(IDENTIFIER)

    def random_runs(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
        # Both lists are walked in order; spans that meet are joined first, so that ends ascend as well.
        joined: list[list[int]] = []
        for a, b, _ in sorted(taken):
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        at = 0
        for m in run.finditer(text):
            start, end = m.span()
            while at < len(joined) and joined[at][1] <= start:
                at += 1
            body = m[0].rstrip("=")
            if len(body) in DIGEST_LENGTHS and digest.fullmatch(body) or identifier.fullmatch(body):
                continue
            if at < len(joined) and joined[at][0] < end:
                continue
            if len(m[0]) < most_chars_per_token * len(tokens.encode_ordinary(m[0])):
                yield start, end, 3

    def find(text: str) -> list[tuple[int, int, int]]:
        spans = [(*m.span(), 0) for m in assign.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
        spans += [(*m.span(), 1) for m in access.finditer(text)]
        spans += [(*m.span(), 2) for m in hexes.finditer(text)]
        spans += list(random_runs(text, spans))
        return sorted(spans, key=lambda s: (s[0], s[2]))

    return find


def span_text(spans) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
