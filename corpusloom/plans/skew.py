"""Joins and lists that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_SHARE of all rows, so fewer than
# HOT_SHARE keys can be hot. That bounds what is broadcast, whatever the data size.
HOT_SHARE = 64
# Ways in which the rows of one hot key are divided.
SPLITS = 64


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """The fewer than ``share`` keys holding more than 1/share of the rows each."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    total = counts.agg(F.sum("__rows").alias("__total")).scalar()
    return counts.filter(F.col("__rows") * share > total).select(*keys)


def balances_joins(df: DataFrame) -> bool:
    """Whether the session splits skewed join partitions at run time."""
    conf = df.sparkSession.conf
    on = [conf.get(f"spark.sql.adaptive.{name}") for name in ("enabled", "skewJoin.enabled")]
    return all(value == "true" for value in on)


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join whose left side may have hot keys (``how``: inner or left).

    Adaptive execution splits a skewed left partition by the map tasks it
    came from and hands each piece the matching right partition, with no extra
    pass over the data. Sessions without it get a salted join.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    if balances_joins(left):
        return left.join(right, list(on), how)
    return salted_join(left, right, on, how)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    splits: int = SPLITS,
    share: int = HOT_SHARE,
) -> DataFrame:
    """Equi-join that salts the hot keys of its left side.

    Left rows of a hot key are divided by the partition they come from, which
    a retried task reproduces; the matching right rows are copied once per
    division. Rows with a null key match nothing and are divided too. All other
    keys join as usual.
    """
    on = list(on)
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    hot = F.broadcast(hot_keys(left, on, share).withColumn("__hot", F.lit(True)))
    salted_left = (
        left.withColumn("__pid", F.spark_partition_id())
        .withColumn("__row", F.monotonically_increasing_id())
        .join(hot, on, "left")
        .withColumn("__salt", F.when(F.col("__hot"), F.col("__pid") % splits).when(null, F.col("__row") % splits).otherwise(0))
        .drop("__hot", "__pid", "__row")
    )
    salted_right = (
        right.join(hot, on, "left")
        .withColumn(
            "__salt",
            F.explode(
                F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(splits - 1))).otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("__hot")
    )
    return salted_left.join(salted_right, [*on, "__salt"], how).drop("__salt")


def first_per_key(df: DataFrame, keys: Sequence, order: Sequence, k: int = 1, rank: str | None = None) -> DataFrame:
    """First ``k`` rows per key in a total order.

    Spark prunes each map task to its own first ``k`` rows per key before the
    shuffle (window group limit), so a hot key sends k rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    name = rank or "__rank"
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)
