"""Keeping an index in step with its source table."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans.skew import first_per_key
from corpusloom.plans.workspace import materialize


# Column of a stored index that spares reading and hashing its content again.
HASH_COLUMN = "content_hash"
# Column of a delta that marks deleted keys.
TOMBSTONE = "__deleted"


def content_hash(content_cols: Sequence[str]) -> Column:
    """md5 of the content columns of a row."""
    # Lengths keep ('ab', 'c') and ('a', 'bc') apart; a null differs from an empty text.
    parts = [
        F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("null"))
        for c in content_cols
    ]
    return F.md5(F.concat_ws("|", *parts))


def _hash_of(df: DataFrame, content_cols: Sequence[str]) -> Column:
    return F.col(HASH_COLUMN) if HASH_COLUMN in df.columns else content_hash(content_cols)


_CHANGE_TYPE = (
    "CASE WHEN __old IS NULL THEN 'insert' WHEN __new IS NULL THEN 'delete' WHEN __old <> __new THEN 'update' END"
)


def changed_keys(old: DataFrame, new: DataFrame, key: str, content_cols: Sequence[str]) -> DataFrame:
    """``key, _change_type`` (insert, update, delete) of what differs.

    Only keys and hashes are shuffled. Keys are unique on both sides, so the
    join cannot be skewed.
    """
    before = old.select(key, _hash_of(old, content_cols).alias("__old"))
    after = new.select(key, _hash_of(new, content_cols).alias("__new"))
    kinds = before.join(after, key, "full").withColumn("_change_type", F.expr(_CHANGE_TYPE))
    return kinds.filter("_change_type is not null").select(key, "_change_type")


def diff_snapshots(old: DataFrame, new: DataFrame, key: str, content_cols: Sequence[str]) -> DataFrame:
    """Changes from ``old`` to ``new``: key, new content and ``_change_type``.

    Keys and hashes are compared first; the content is only fetched for the
    keys that changed, which Spark broadcasts when they are few.
    """
    changes = changed_keys(old, new, key, content_cols)
    return changes.join(new.select(key, *content_cols), key, "left").select(key, *content_cols, "_change_type")


def apply_changes(index: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The index after the changes: kept rows, plus inserted and updated ones.

    ``changes`` holds the columns of the index and ``_change_type``.
    """
    kept = index.join(changes.select(key), key, "left_anti")
    written = changes.filter("_change_type <> 'delete'").select(*index.columns)
    return kept.select(*index.columns).unionByName(written)


# A log-structured index: parts ``part=<first>-<last>`` of a folder cover syncs by number.


@dataclass(frozen=True)
class Part:
    """Complete part of an index: the changes of the syncs ``first`` to ``last``; from the first sync on it is a base."""

    first: int
    last: int
    path: str
    size: int

    @property
    def is_base(self) -> bool:
        return self.first == 1


# Deltas together may have this share of the base's bytes before all is merged into a new base.
MOST_DELTA = 0.5
# A delta is merged with the one before it while that has no more than this many times its bytes.
TIER = 2.0


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _parts(spark: SparkSession, root: str) -> tuple[list[Part], int]:
    """All complete parts, and the largest number that any part has, complete or not."""
    folder, fs = _files(spark, root)
    out, largest = [], 0
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        match = re.fullmatch(r"part=(\d+)-(\d+)(?:-\w+)?", status.getPath().getName())
        if match:
            path = status.getPath().toString()
            largest = max(largest, int(match[2]))
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")):
                out.append(Part(int(match[1]), int(match[2]), path, fs.getContentSummary(status.getPath()).getLength()))
    return out, largest


def current_parts(spark: SparkSession, root: str) -> list[Part]:
    """The base and its deltas in order: of the parts that end alike the one that reaches back furthest."""
    parts, _ = _parts(spark, root)
    chain: list[Part] = []
    ends = max((p.last for p in parts if p.is_base), default=0)
    ends = max((p.last for p in parts if p.last >= ends), default=0)
    while ends:
        part = min((p for p in parts if p.last == ends), key=lambda p: p.first)
        chain.append(part)
        # Numbers of syncs that failed are missing; the next part is the one that ends last before this one begins.
        ends = max((p.last for p in parts if p.last < part.first), default=0)
    return chain[::-1]


def _publish(df: DataFrame, root: str, first: int, last: int) -> None:
    """A part counts once Spark has marked it complete; a failed one stays unread under a name of its own."""
    df.write.mode("errorifexists").parquet(f"{root}/part={first:08d}-{last:08d}-{uuid.uuid4().hex[:8]}")


def _newest(spark: SparkSession, deltas: Sequence[Part], key: str) -> DataFrame:
    """The last row of every key in the deltas, tombstones included."""
    out = None
    for part in deltas:
        rows = spark.read.parquet(part.path).withColumn("__sync", F.lit(part.last))
        out = rows if out is None else out.unionByName(rows)
    return out.drop("__sync") if len(deltas) == 1 else first_per_key(out, [key], [F.desc("__sync")]).drop("__sync")


def _merged(spark: SparkSession, parts: Sequence[Part], key: str) -> DataFrame:
    """Merge on read: deltas over the base. Few changed keys are broadcast by Spark, so the base is not shuffled for them."""
    base = spark.read.parquet(parts[0].path)
    if len(parts) == 1:
        return base
    newest = _newest(spark, parts[1:], key)
    kept = base.join(newest.select(key), key, "left_anti").select(*base.columns)
    return kept.unionByName(newest.filter(f"NOT {TOMBSTONE}").select(*base.columns))


def current_version(spark: SparkSession, root: str, key: str | None = None) -> DataFrame | None:
    """The index as of the last complete sync, or None. ``key`` defaults to its first column."""
    parts = current_parts(spark, root)
    if not parts:
        return None
    return _merged(spark, parts, key or spark.read.parquet(parts[0].path).columns[0])


def compact(spark: SparkSession, root: str, key: str, most_delta: float = MOST_DELTA, tier: float = TIER) -> None:
    """Merge what has grown: all parts once the deltas outweigh ``most_delta`` of the base, else deltas of like size.

    Every byte is so rewritten a number of times that grows with the logarithm
    of the changes, and a read meets that many deltas at most.
    """
    base, *deltas = current_parts(spark, root)
    if sum(d.size for d in deltas) > most_delta * base.size:
        _publish(_merged(spark, [base, *deltas], key), root, 1, deltas[-1].last)
        return
    first = len(deltas)
    while first > 1 and deltas[first - 2].size <= tier * sum(d.size for d in deltas[first - 1 :]):
        first -= 1
    if first < len(deltas):
        together = deltas[first - 1 :]
        _publish(_newest(spark, together, key), root, together[0].first, together[-1].last)


def drop_superseded(spark: SparkSession, root: str) -> int:
    """Remove parts that newer ones cover, and what failed syncs left; for times without readers. Returns their number."""
    kept = {p.path for p in current_parts(spark, root)}
    folder, fs = _files(spark, root)
    gone = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part=") and s.getPath().toString() not in kept]
    for path in gone:
        fs.delete(path, True)
    return len(gone)


def sync_index(source: DataFrame, root: str, key: str, content_cols: Sequence[str], build) -> DataFrame:
    """Create the index when absent, else write what changed as a delta; returns the change counts.

    ``build`` turns source rows into index rows (embedding them, for
    instance) and is run on inserted and updated rows only. When it adds a
    ``content_hash`` column (:func:`content_hash`), later runs compare by it
    and do not read the content of the index. A delta holds the new rows,
    sorted by key, and a tombstone per deleted key; a sync that fails leaves
    nothing that is read. One sync runs at a time.
    """
    spark = source.sparkSession
    parts, largest = current_parts(spark, root), _parts(spark, root)[1]
    if not parts:
        # Under number 1 always: what an earlier attempt left has another name and is not complete.
        _publish(build(source), root, 1, 1)
        fresh = current_version(spark, root, key)
        return fresh.agg(F.count(F.lit(1)).alias("count")).select(F.lit("insert").alias("_change_type"), "count")
    index = _merged(spark, parts, key)
    # Written once: read again to count and to fetch the new content.
    changes = materialize(changed_keys(index, source, key, content_cols), "index-changes")
    counts = changes.groupBy("_change_type").agg(F.count(F.lit(1)).alias("count"))
    if changes.isEmpty():
        return counts
    # Written, so Spark knows their size: few changes are broadcast, and the source is not shuffled.
    fresh = source.join(changes.filter("_change_type <> 'delete'").select(key), key, "left_semi")
    rows = build(fresh).select(*index.columns).withColumn(TOMBSTONE, F.lit(False))
    gone = changes.filter("_change_type = 'delete'").select(key).withColumn(TOMBSTONE, F.lit(True))
    delta = rows.unionByName(gone, allowMissingColumns=True).sortWithinPartitions(key)
    _publish(delta, root, largest + 1, largest + 1)
    compact(spark, root, key)
    return counts
