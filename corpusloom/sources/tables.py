"""Snapshots, CSV files, managed tables and namespaces."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

_NAME = re.compile(r"[A-Za-z0-9_]+(\.[A-Za-z0-9_]+)*")


def _checked(name: str) -> str:
    """Quote a catalog, schema or table name; other characters are refused."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return ".".join(f"`{part}`" for part in name.split("."))


def load_snapshot(spark: SparkSession, path: str, drop: Sequence[str] = ()) -> DataFrame:
    """A parquet snapshot without the columns in ``drop``; they are not read."""
    return spark.read.parquet(path).drop(*drop)


def load_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header.

    Without a schema the types are inferred, which reads the files twice.
    ``multi_line`` allows line breaks in quoted fields; such files cannot be split among tasks.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def from_items(spark: SparkSession, items: Iterable[str], name: str) -> DataFrame:
    """A small driver-side list as a one-column DataFrame."""
    return spark.createDataFrame(list(items), StringType()).toDF(name)


def from_frame(spark: SparkSession, frame: pd.DataFrame, schema: StructType | str | None = None) -> DataFrame:
    """A small driver-side pandas frame as a DataFrame."""
    return spark.createDataFrame(frame, schema=schema)


def ensure_table(
    spark: SparkSession, name: str, builder: Callable[[], DataFrame], path: str | None = None
) -> DataFrame:
    """The table ``name``, built first when it is missing or empty."""
    _checked(name)
    if not spark.catalog.tableExists(name) or spark.table(name).isEmpty():
        overwrite_table(builder(), name, path=path)
    return spark.table(name)


def overwrite_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """Replace the whole table; with ``path`` its files are kept outside the warehouse."""
    _checked(name)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def use_schema(spark: SparkSession, schema: str) -> None:
    """Create the schema when missing and make it current."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_checked(schema)}")
    spark.sql(f"USE {_checked(schema)}")


def drop_schema(spark: SparkSession, schema: str, cascade: bool = False) -> None:
    """Drop a schema; its tables go too only with ``cascade=True``."""
    spark.sql(f"DROP SCHEMA IF EXISTS {_checked(schema)} {'CASCADE' if cascade else 'RESTRICT'}")


def current_namespace(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT current_catalog() AS catalog, current_schema() AS schema, current_user() AS user")


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def user_slug(email) -> F.Column:
    """Name usable as a schema suffix: the part before ``@`` without dots and dashes."""
    return F.translate(F.substring_index(email, "@", 1), ".-", "")


def with_chunk_id(df: DataFrame, url: str = "url", pos: str = "pos", content: str = "content") -> DataFrame:
    """Key derived from the content, so that a rerun gives the same ids."""
    key = F.md5(F.concat_ws("|", F.col(url).cast("string"), F.col(pos).cast("string"), F.col(content)))
    return df.withColumn("id", key)


def hash_bucket(key, seed: int = 0, buckets: int = 1000):
    """Bucket of a key: leading 32 bits of its md5, modulo ``buckets``."""
    text = F.col(key).cast("string") if isinstance(key, str) else key.cast("string")
    salted = F.concat(F.lit(f"{seed}:"), text) if seed else text
    return F.conv(F.substr(F.md5(salted), F.lit(1), F.lit(8)), 16, 10).cast("long") % buckets


def hash_split(df: DataFrame, key: str, weights: dict[str, int], seed: int = 0) -> DataFrame:
    """Column ``split`` with the name drawn by weight; depends on the key alone, not on the plan."""
    bucket = hash_bucket(key, seed, sum(weights.values()))
    split, edge = None, 0
    for name, weight in weights.items():
        edge += weight
        split = F.when(bucket < edge, name) if split is None else split.when(bucket < edge, name)
    return df.withColumn("split", split)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 0, cap: int | None = None) -> DataFrame:
    """Repeatable sample by key; with ``cap``, the first rows in hash order."""
    taken = df.filter(hash_bucket(key, seed, 1_000_000) < round(fraction * 1_000_000))
    if cap is None:
        return taken
    return taken.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(cap)
