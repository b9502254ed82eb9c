"""Run-to-completion incremental jobs with exactly-once sinks.

All transformations are stateless, so no state grows with the stream. A file
sink keeps one log of committed batches, which two queries cannot share: each
source of a common table therefore has its own subfolder (``source=name``) and
its own checkpoint, and :func:`read_sources` puts the committed parts together.
:mod:`corpusloom.streaming.shared_table` feeds one folder from several streams.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from corpusloom.sources.files import bounded

# Seconds to wait for the events of a query that has ended.
EVENTS_WAIT = 120


def table_stream(
    spark: SparkSession, table: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """New rows of a table; the bounds hold per batch, so that a large backlog is not one batch."""
    return bounded(spark.readStream, max_files, max_bytes).table(table)


def source_path(root: str, source: str) -> str:
    """Folder of one source of a table fed by several streams."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", source):
        raise ValueError(f"not a plain source name: {source!r}")
    return f"{root}/source={source}"


def read_sources(spark: SparkSession, root: str) -> DataFrame:
    """Bag union of all committed batches of all sources under ``root``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    paths = sorted(s.getPath().toString() for s in listed if s.getPath().getName().startswith("source="))
    # Each folder is read by itself, as only then its log of committed files is used.
    out = None
    for path in paths:
        part = spark.read.option("basePath", path).parquet(path)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError(f"no sources under {root}")
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _table_location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").select("data_type").head()
    return rows[0] if rows else None


@contextmanager
def counted(spark: SparkSession) -> Iterator[Callable[[StreamingQuery], dict]]:
    """Counts of a finished query from all its progress events; a query itself keeps only the last ones."""
    batches: dict[str, dict[int, int]] = defaultdict(dict)
    ended: dict[str, Event] = defaultdict(Event)

    class Progress(StreamingQueryListener):
        def onQueryStarted(self, event) -> None:
            pass

        def onQueryProgress(self, event) -> None:
            progress = event.progress
            batches[str(progress.runId)][progress.batchId] = progress.numInputRows

        def onQueryIdle(self, event) -> None:
            pass

        def onQueryTerminated(self, event) -> None:
            ended[str(event.runId)].set()

    def counts(query: StreamingQuery) -> dict:
        # Events come in order, so the end of the run comes after all its batches.
        if not ended[str(query.runId)].wait(EVENTS_WAIT):
            raise TimeoutError("no end event of the streaming query")
        rows = batches[str(query.runId)]
        return {"batches": len(rows), "input_rows": sum(rows.values())}

    listener = Progress()
    spark.streams.addListener(listener)
    try:
        yield counts
    finally:
        spark.streams.removeListener(listener)


def run_incremental(df: DataFrame, target: str, checkpoint: str, is_path: bool = False) -> dict:
    """Append everything new to ``target`` and stop; returns counts of this run.

    ``target`` is a table name, or a folder with ``is_path=True``. The
    checkpoint records what was read, so a repeated run adds only new input
    and a failed one resumes without duplicates.
    """
    spark = df.sparkSession
    location = target if is_path else _table_location(spark, target)
    if location and _exists(spark, f"{location}/_spark_metadata") and not _exists(spark, checkpoint):
        # The sink would take the new batches for ones already written and skip them.
        raise ValueError(f"{target} is fed by another checkpoint; give each source its own folder (source_path)")
    writer = (
        df.writeStream.outputMode("append")
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .format("parquet")
    )
    with counted(spark) as counts:
        query = writer.start(target) if is_path else writer.toTable(target)
        query.awaitTermination()
        return counts(query)


def run_incremental_corpus(
    source_stream: DataFrame,
    target: str,
    checkpoint: str,
    chunker: Callable[[DataFrame], DataFrame],
    embedder: Callable[[DataFrame], DataFrame],
    is_path: bool = False,
    partitions: int | None = None,
) -> dict:
    """Chunk and embed new source rows and append them to ``target``.

    ``chunker`` must get raw text: text cut into chunks earlier would be cut
    again. ``partitions`` spreads sources that arrive in few large files.
    """
    if partitions:
        source_stream = source_stream.repartition(partitions)
    return run_incremental(embedder(chunker(source_stream)), target, checkpoint, is_path)
