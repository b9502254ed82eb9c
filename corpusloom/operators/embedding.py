"""Embedding of text columns and the index table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import tokens

# Fixed value: inputs per call of an embedding backend.
MAX_BATCH = 150

Backend = Callable[[list[str]], Sequence[Sequence[float]]]


def _hashed_bag(dim: int):
    """Arrow UDF from token lists to unit vectors, a whole batch at a time.

    The leading 32 bits of a token's md5 give its slot, the last hex digit
    its sign (below 8: plus). Each distinct token of a batch is hashed once.
    """

    def slot_and_sign(token: str) -> tuple[int, int]:
        digest = hashlib.md5(token.encode(), usedforsecurity=False).digest()
        return int.from_bytes(digest[:4], "big") % dim, 1 if digest[-1] % 16 < 8 else -1

    @F.arrow_udf("array<float>")
    def pack(token_lists: pa.Array) -> pa.Array:
        n = len(token_lists)
        sums = np.zeros((n, dim))
        flat = token_lists.flatten().dictionary_encode()
        if len(flat):
            hashed = np.array([slot_and_sign(t) for t in flat.dictionary.to_pylist()], dtype=np.int64)
            slots, signs = hashed[flat.indices.to_numpy(zero_copy_only=False)].T
            lengths = token_lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(n), lengths)
            sums = np.bincount(rows * dim + slots, weights=signs, minlength=n * dim).reshape(n, dim)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        unit = (sums / np.where(size == 0, 1.0, size)).astype(np.float32)
        offsets = pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(unit.ravel()))

    return pack


def embed(
    df: DataFrame,
    col: str,
    backend: Backend | None = None,
    dim: int = 1024,
    max_batch: int = MAX_BATCH,
    out: str = "embedding",
) -> DataFrame:
    """Add the embedding of ``col`` as ``array<float>``.

    ``backend`` gets at most ``max_batch`` texts per call and returns their
    vectors in order; an error fails the task. Without a backend a hashed bag
    of tokens is used: a baseline for tests, not a language model. The UDF is
    marked non-deterministic so that pushed filters do not run it twice.
    """
    if backend is None:
        return df.withColumn(out, _hashed_bag(dim).asNondeterministic()(tokens(F.lower(F.col(col)))))

    @F.arrow_udf("array<float>")
    def call(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = batch.to_pylist()
            vectors: list = []
            for start in range(0, len(texts), max_batch):
                part = texts[start : start + max_batch]
                got = list(backend(part))
                if len(got) != len(part):
                    raise ValueError(f"backend returned {len(got)} vectors for {len(part)} texts")
                vectors.extend(got)
            yield pa.array([[float(x) for x in v] for v in vectors], type=pa.list_(pa.float32()))

    return df.withColumn(out, call.asNondeterministic()(F.col(col)))


def build_index(
    df: DataFrame, id: str = "id", vector: str = "embedding", columns: Sequence[str] = (), dim: int | None = None
) -> DataFrame:
    """Index rows ``id, embedding, columns``; a vector of another length fails the job."""
    checked = F.col(vector)
    if dim is not None:
        checked = F.when(F.size(checked) == dim, checked).otherwise(
            F.raise_error(F.concat(F.lit(f"expected {dim} dimensions, got "), F.size(checked).cast("string")))
        )
    return df.select(F.col(id).alias("id"), checked.alias("embedding"), *columns)
