"""One table fed by several streams, each batch once.

A batch is written to a folder of its own and counts when its commit appears:
a file named for the feed and the batch that holds the folder's name. A commit
is created by renaming a finished file, which fails where there is one, so a
batch that is run again after its commit adds nothing and of two attempts one
counts. Readers see the folders that commits name and nothing else.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.streaming.incremental import counted


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _plain(feed: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_]+", feed):
        raise ValueError(f"not a plain feed name: {feed!r}")
    return feed


def is_committed(spark: SparkSession, root: str, feed: str, batch: int) -> bool:
    path, fs = _fs(spark, f"{root}/_commits/{_plain(feed)}-{batch}")
    return fs.exists(path)


def append_batch(rows: DataFrame, root: str, feed: str, batch: int) -> bool:
    """Add ``rows`` as a batch of a feed; False when that batch was committed before."""
    spark = rows.sparkSession
    if is_committed(spark, root, feed, batch):
        return False
    name = f"{feed}-{batch}-{uuid.uuid4().hex}"
    rows.write.parquet(f"{root}/data/{name}")
    draft, fs = _fs(spark, f"{root}/_drafts/{name}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(name.encode()))
    finally:
        out.close()
    final, _ = _fs(spark, f"{root}/_commits/{feed}-{batch}")
    fs.mkdirs(final.getParent())
    # Local file systems rename over a file, others refuse.
    return False if fs.exists(final) else bool(fs.rename(draft, final))


def committed_folders(spark: SparkSession, root: str) -> list[str]:
    folder, fs = _fs(spark, f"{root}/_commits")
    names = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        if status.getPath().getName().startswith("."):
            continue
        opened = fs.open(status.getPath())
        try:
            names.append(bytes(opened.readAllBytes()).decode())
        finally:
            opened.close()
    return [f"{root}/data/{name}" for name in sorted(names)]


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """All committed batches of all feeds, one scan."""
    folders = committed_folders(spark, root)
    if not folders:
        raise ValueError(f"nothing committed under {root}")
    return spark.read.parquet(*folders)


def feed_table(stream: DataFrame, root: str, checkpoint: str, feeds: dict[str, Callable[[DataFrame], DataFrame]]) -> dict:
    """Append everything new of a stream to the table at ``root`` and stop; returns counts of this run.

    ``feeds`` names what is made of every batch: one feed, or several from the
    same rows, which are then read once. Other streams may feed the same
    table under other names. A name belongs to one checkpoint: batches are
    told apart by their numbers.
    """
    spark = stream.sparkSession
    for name in feeds:
        _plain(name)

    def write(batch: DataFrame, number: int) -> None:
        several = len(feeds) > 1
        if several:
            # Blocks that executors lose are computed again from the batch's input.
            batch.persist()
        try:
            for name, make in feeds.items():
                append_batch(make(batch), root, name, number)
        finally:
            if several:
                batch.unpersist()

    with counted(spark) as counts:
        query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start()
        query.awaitTermination()
        return counts(query)
