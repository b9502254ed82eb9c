"""Token counts from flat token files that carry no index.

A token file is a stream of fixed-width ids in which one identifier ends every
document. It is read in blocks that know nothing of documents: each block is
searched for the identifier in one vector operation and reports the tokens
before its first separator, the lengths between separators and the tokens after
the last one. A prefix scan over the blocks of a file stitches documents that
span blocks and numbers them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.texts import byte_slices
from corpusloom.llm.vocabulary import DEFAULT_PATH, encoding, read_ranks

# The id after the vocabulary's last one ends a document.
END = 50256
# Ids of a block. A document may span any number of blocks.
BLOCK_TOKENS = 1 << 18


def write_token_files(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str = DEFAULT_PATH,
    end: int = END,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Tokenize whole texts into one stream per partition of ``docs``, cut into blocks.

    Rows of the table at ``path``: ``kind`` ``tokens`` (file, block, data: ids
    as little-endian uint16) and ``kind`` ``ids`` (file, block: the first
    ordinal, ids: the document ids from there on). The id lists only serve to
    name the counted documents; the scan does not see them. A null text has no
    tokens and still ends with the separator. A repeated task writes the same
    rows, as a partition's content and order come from its input split.
    """
    ranks = read_ranks(vocabulary)
    id_kind, id_type = docs.schema[id_column].dataType.simpleString(), to_arrow_type(docs.schema[id_column].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, tokens = TaskContext.get().partitionId(), encoding(ranks)
        held, size, block, ordinal = [], 0, 0, 0

        def row(kind: str, block: int, data: bytes | None, ids: pa.Array | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([kind]),
                    pa.array([file], pa.int64()),
                    pa.array([block], pa.int64()),
                    pa.array([data], pa.binary()),
                    pa.array([None if ids is None else ids.to_pylist()], pa.list_(id_type)),
                ],
                ["kind", "file", "block", "data", "ids"],
            )

        for batch in batches:
            for part in byte_slices(batch, text_column):
                yield row("ids", ordinal, None, part.column(0))
                ordinal += part.num_rows
                for text in part.column(1).to_pylist():
                    ids = tokens.encode_ordinary(text or "")
                    ids.append(end)
                    held.append(np.array(ids, "<u2"))
                    size += len(ids)
                if size >= block_tokens:
                    stream = np.concatenate(held)
                    whole = size - size % block_tokens
                    for at in range(0, whole, block_tokens):
                        yield row("tokens", block, stream[at : at + block_tokens].tobytes(), None)
                        block += 1
                    held, size = [stream[whole:]], size - whole
        if size:
            yield row("tokens", block, np.concatenate(held).tobytes(), None)

    streams = docs.select(id_column, text_column).mapInArrow(
        run, f"kind string, file bigint, block bigint, data binary, ids array<{id_kind}>"
    )
    streams.write.mode("errorifexists").parquet(path)


def read_token_blocks(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, data`` of the streams under ``path``."""
    return spark.read.parquet(path).filter("kind = 'tokens'").select("file", "block", "data")


def read_document_ids(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """``file, ordinal, id`` of the streams under ``path``, in the order of writing."""
    lists = spark.read.parquet(path).filter("kind = 'ids'").select("file", "block", F.posexplode("ids"))
    return lists.select("file", (F.col("block") + F.col("pos")).alias("ordinal"), F.col("col").alias(id_column))


def read_flat_files(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, block, data`` of raw binary files of ids. A file is held whole in one task, so keep files under 2 GB."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    step = width * block_tokens

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = content.as_buffer()
                for block, at in enumerate(range(0, data.size, step)):
                    piece = data.slice(at, min(step, data.size - at)).to_pybytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file]), pa.array([block], pa.int64()), pa.array([piece], pa.binary())],
                        ["file", "block", "data"],
                    )

    return files.mapInArrow(cut, "file string, block bigint, data binary")


def count_tokens(blocks: DataFrame, end: int = END, dtype: str = "<u2") -> DataFrame:
    """``file, ordinal, n_tokens`` per document of the streams, separators not counted.

    ``blocks`` has ``file, block, data``; blocks of a file are numbered in
    order and may end anywhere between two ids. Tokens after a file's last
    separator are a last document of their own. Files without data give no
    rows. What meets per file is one short row per block, never the ids.
    """
    kind = blocks.schema["file"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, inner, tails = [], [], []
            for data in batch.column(2):
                ids = np.frombuffer(data.as_buffer() if data.is_valid else b"", dtype)
                at = np.flatnonzero(ids == end)
                heads.append(int(at[0]) if len(at) else len(ids))
                inner.append(np.diff(at) - 1 if len(at) else None)
                tails.append(int(len(ids) - at[-1] - 1) if len(at) else len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(heads, pa.int64()),
                    pa.array(inner, pa.list_(pa.int64())),
                    pa.array(tails, pa.int64()),
                ],
                ["file", "block", "head", "inner", "tail"],
            )

    found = blocks.select("file", "block", "data").mapInArrow(
        scan, f"file {kind}, block bigint, head bigint, inner array<bigint>, tail bigint"
    )
    ends = F.when(F.col("inner").isNull(), 0).otherwise(F.size("inner") + 1).cast("long")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Tokens seen so far, and how many of them the last separator before this block closed off.
    closed = F.when(F.col("ends") > 0, F.col("all") - F.col("tail"))
    scanned = (
        found.withColumn("ends", ends)
        .withColumn("tokens", F.when(F.col("ends") > 0, F.col("head") + F.col("tail") + F.aggregate("inner", F.lit(0).cast("long"), lambda s, x: s + x)).otherwise(F.col("head")))
        .withColumn("earlier", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
        .withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0)))
        .withColumn("all", F.col("earlier") + F.col("tokens"))
        .withColumn("open", F.col("earlier") - F.coalesce(F.max(closed).over(before), F.lit(0)))
        .withColumn("last", F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull())
    )
    lengths = F.when(
        F.col("ends") > 0, F.concat(F.array(F.col("open") + F.col("head")), F.col("inner"))
    ).otherwise(F.array().cast("array<bigint>"))
    rest = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("open") + F.col("head"))
    lengths = F.when(F.col("last") & (rest > 0), F.concat(lengths, F.array(rest))).otherwise(lengths)
    return scanned.select("file", "first", F.posexplode(lengths)).select(
        "file", (F.col("first") + F.col("pos")).alias("ordinal"), F.col("col").alias("n_tokens")
    )
