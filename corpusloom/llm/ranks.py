"""Gapless ranks and running sums without a window over a whole group.

Rows are ordered by a hash, which also deals them into about sqrt(rows) buckets
in the same order. Sums of the buckets give each bucket's start; a window runs
within a bucket only. No task meets more than a bucket, or one group's list of
bucket sums, whatever share of the rows a group holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_bits(rows: int) -> int:
    return max(1, (max(rows, 1).bit_length() + 1) // 2)


def ranked(
    df: DataFrame, groups: Sequence[str], order: Column, rows: int, rank: str = "rank", weight: str | None = None
) -> DataFrame:
    """Add ``rank`` from 0 within ``groups`` along ``order`` (a long hash); with ``weight``, also ``before``, its sum over earlier rows.

    ``rows`` sets the number of buckets only. Rows with equal hashes follow each
    other in any order, so hash everything that tells rows apart.
    """
    groups = list(groups)
    hashed = df.withColumn("__h", order)
    hashed = hashed.withColumn("__bucket", F.shiftrightunsigned("__h", 64 - bucket_bits(rows)))
    sums = [F.count(F.lit(1)).alias("__n"), F.sum(weight).alias("__w")] if weight else [F.count(F.lit(1)).alias("__n")]
    keys = [*groups, "__bucket"]
    totals = hashed.groupBy(*keys).agg(*sums)
    earlier = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in (["__n", "__w"] if weight else ["__n"])],
    )
    within = Window.partitionBy(*keys).orderBy("__h")
    out = hashed.withColumn("__r", F.row_number().over(within) - 1)
    if weight:
        running = F.sum(weight).over(within.rowsBetween(Window.unboundedPreceding, -1))
        out = out.withColumn("__b", F.coalesce(running, F.lit(0)))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    out = out.join(starts, same).withColumn(rank, F.col("__n0") + F.col("__r"))
    if weight:
        out = out.withColumn("before", F.col("__w0") + F.col("__b"))
    return out.drop(*[c for c in out.columns if c.startswith("__")])
