"""Parallelism of scans that feed CPU-heavy work."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Least bytes of a file, as stored, that make a partition worth a task of its own.
WORTH_A_TASK = 128 * 1024
# Bytes of a scan, as stored, up to which spreading it costs next to nothing. Larger scans are split by
# spark.sql.files.maxPartitionBytes and never shuffled here. Only the parallelism depends on it, no result.
MOST_BYTES = 256 * 1024 * 1024


def spread(scan: DataFrame, at_least: int | None = None) -> DataFrame:
    """Repartition a small file scan that has fewer splits than cores.

    A scan of more than ``MOST_BYTES`` is left alone however few splits it has;
    a small file held in one split is spread out, into no more parts than its
    size is worth. Meant for scans: counting the splits plans the scan but runs
    nothing.
    """
    if scan.isStreaming:
        return scan
    wanted = at_least
    if wanted is None:
        size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size > MOST_BYTES:
            return scan
        wanted = min(scan.sparkSession.sparkContext.defaultParallelism, -(-size // WORTH_A_TASK))
    if scan.rdd.getNumPartitions() >= wanted:
        return scan
    return scan.repartition(wanted)
