"""Folders of files as batch or streaming input."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

# Fixed value: columns of the binary file source.
BINARY_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def bounded(reader: DataStreamReader, max_files: int | None = None, max_bytes: int | None = None) -> DataStreamReader:
    """Limits of one batch of a file stream, by files or by bytes."""
    if max_files and max_bytes:
        raise ValueError("a batch is bounded by files or by bytes")
    if max_files:
        return reader.option("maxFilesPerTrigger", max_files)
    return reader.option("maxBytesPerTrigger", max_bytes) if max_bytes else reader


def stream_files(spark: SparkSession, folder: str, glob: str = "*", max_files: int | None = None) -> DataFrame:
    """New files of a folder as a stream of (path, modificationTime, length, content)."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
    return bounded(reader, max_files).load(folder)


def stream_lines(
    spark: SparkSession, folder: str, glob: str = "*", separator: str = "\n", max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Lines of new text files of a folder as a stream of (path, start, line).

    Files are cut into ranges of ``spark.sql.files.maxPartitionBytes``, each
    read by a task of its own from the line that begins in it, so a file may
    have any size; no task and no row holds a whole one. ``start`` is where
    the range begins.
    """
    reader = spark.readStream.format("text").option("pathGlobFilter", glob).option("lineSep", separator)
    lines = bounded(reader, max_files, max_bytes).load(folder)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def read_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)


def stream_parquet(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    glob: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """New parquet files of a folder (or one file) as a stream; the bounds hold per batch."""
    reader = bounded(spark.readStream.schema(schema), max_files, max_bytes)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # As a pattern, the path may be a folder or one file.
    plain = not re.search(r"[][{}*?\\]", folder)
    return reader.parquet(f"{folder[:-1]}[{folder[-1]}]" if plain and not folder.endswith("/") else folder)


def decode_text(df: DataFrame, parser: Callable[[bytes], str | None] | None = None, out: str = "text") -> DataFrame:
    """Text of binary contents: UTF-8, or what ``parser`` makes of each file.

    A parser that raises gives null, as a file that cannot be read is skipped
    by the later filters.
    """
    if parser is None:
        return df.withColumn(out, F.decode(F.col("content"), "UTF-8"))

    @F.pandas_udf("string")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(body: bytes) -> str | None:
            try:
                return parser(body)
            except Exception:
                return None

        for batch in batches:
            yield batch.map(one)

    return df.withColumn(out, parse("content"))
