"""Whole texts in Arrow batches: slices bounded in bytes, and words as the contracts cut them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Bytes of text handled at once in a task. One longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive pieces of ``batch`` whose texts hold about ``limit`` bytes; every row comes in one of them."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > first and held + size > limit:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)


def map_texts(
    df: DataFrame,
    columns: Sequence[str],
    text: str,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Map slices of ``columns`` through the function that ``make()`` builds once per task. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in byte_slices(batch, text, limit):
                yield work(part)

    return df.select(*columns).mapInArrow(run, schema)


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of ``[^\\x20\\x09-\\x0D]+``: bytes.split() splits on exactly those six bytes."""
    return [] if text is None else text.split()


def raw_texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()
