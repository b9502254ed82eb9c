"""Fetching with a store of bodies: what was fetched is not asked for again.

The store is a folder of complete subfolders, one per wave of addresses. A wave
is one job, so a lost executor repeats its own tasks and a job that fails keeps
all waves before it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans.skew import skew_join
from corpusloom.plans.workspace import complete_folders

Fetcher = Callable[[str], str | None]
STORED = "url_key string, url string, body string"
# Addresses of one wave; a failed job loses one wave at most.
WAVE = 100_000


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(F.col(url), "^[^/]*//([^/]*)", 1))


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """``url_key, url, body``: one body per address, as kept by complete waves."""
    folders = complete_folders(spark, store)
    if not folders:
        return spark.createDataFrame([], STORED)
    # Two runs at a time may both fetch an address: the lesser body stays, whichever wave is read first.
    rows = spark.read.schema(STORED).parquet(*folders)
    return rows.groupBy("url_key").agg(F.min(F.struct("url", "body")).alias("r")).select("url_key", "r.url", "r.body")


def missing_urls(df: DataFrame, store: str, url: str = "url") -> DataFrame:
    """``url_key, url``: distinct addresses that the store has no body of; null addresses are left out."""
    wanted = df.select(F.col(url).alias("url")).filter("url is not null").distinct().select(F.md5("url").alias("url_key"), "url")
    folders = complete_folders(df.sparkSession, store)
    if not folders:
        return wanted
    known = df.sparkSession.read.schema(STORED).parquet(*folders).select("url_key")
    return wanted.join(known, "url_key", "left_anti")


def fetch_missing(
    df: DataFrame,
    fetcher: Fetcher,
    store: str,
    url: str = "url",
    workers: int = 32,
    partitions: int = 64,
    lanes: int = 1,
    pause: float = 0.0,
    wave: int = WAVE,
) -> int:
    """Fetch what the store lacks and return how many addresses were asked for.

    Addresses of one host go to ``lanes`` tasks, so no host is called by more
    than ``lanes * workers`` threads; a task waits ``pause`` seconds after each
    group of ``workers`` addresses. A group is written before the next one is
    fetched, so a task holds ``workers`` bodies. Addresses without a body
    (errors, other statuses) are not kept and are asked again by the next run.
    """
    if min(workers, partitions, lanes, wave) < 1:
        raise ValueError("workers, partitions, lanes and wave are 1 or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(max_workers=workers) as pool:
            for batch in batches:
                for first in range(0, batch.num_rows, workers):
                    part = batch.slice(first, workers)
                    bodies = pa.array(list(pool.map(fetcher, part.column(1).to_pylist())), pa.string())
                    done = pa.RecordBatch.from_arrays([part.column(0), part.column(1), bodies], ["url_key", "url", "body"])
                    yield done.filter(bodies.is_valid())
                    if pause:
                        time.sleep(pause)

    spark = df.sparkSession
    todo = missing_urls(df, store, url)
    # The list is written first: later waves must not see the bodies that earlier ones add.
    listed = f"{store}.frontier/{uuid4().hex}"
    todo.write.parquet(listed)
    todo = spark.read.schema("url_key string, url string").parquet(listed)
    total = todo.count()
    waves = -(-total // wave)
    lane = F.pmod(F.xxhash64("url"), F.lit(lanes))
    for number in range(waves):
        part = todo.filter(F.pmod(F.xxhash64("url_key"), F.lit(waves)) == number)
        dealt = part.repartition(partitions, host_of("url"), lane)
        dealt.mapInArrow(run, STORED).write.parquet(f"{store}/{uuid4().hex}")
    return total


def fetch_stored(df: DataFrame, fetcher: Fetcher, store: str, url: str = "url", out: str = "html", **options) -> DataFrame:
    """``df`` with the body of each address (null where there is none), fetching only what the store lacks.

    Runs the fetch when called; options are those of :func:`fetch_missing`.
    """
    fetch_missing(df, fetcher, store, url, **options)
    bodies = read_store(df.sparkSession, store).select(F.col("url_key").alias("__url_key"), F.col("body").alias(out))
    keyed = df.drop(out).withColumn("__url_key", F.md5(F.col(url)))
    return skew_join(keyed, bodies, ["__url_key"], "left").drop("__url_key")
