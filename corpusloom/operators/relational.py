"""Joins, aggregates and latest-per-key picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.term_trie import nearest_terms
from corpusloom.plans.skew import first_per_key, skew_join


def top_groups(fact: DataFrame, dim: DataFrame, on: str, name_col: str, id_col: str, k: int = 10) -> DataFrame:
    """The ``k`` dimension names with most facts.

    Facts are counted per key before the join, so the join sees one row per
    key however unevenly the facts are spread.
    """
    per_key = fact.groupBy(on).agg(F.count(id_col).alias("__n"))
    return (
        per_key.join(dim.select(on, name_col), on)
        .groupBy(F.col(name_col).alias("name"))
        .agg(F.sum("__n").cast("long").alias("purchases"))
        .orderBy(F.desc("purchases"), "name")
        .limit(k)
    )


def latest_per_key(
    df: DataFrame, keys: Sequence, order_cols: Sequence[str], tie_cols: Sequence[str] = ()
) -> DataFrame:
    """Latest row per key; ``tie_cols`` make the order total."""
    return first_per_key(df, keys, [F.desc(c) for c in [*order_cols, *tie_cols]])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts of the non-null values."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(df: DataFrame, truth: str, pred: str, classes: Sequence) -> DataFrame:
    """Rows by truth, one column per predicted class, 0 where a pair is absent.

    Replies outside the classes and missing ones are counted in ``other``.
    """
    inside = F.when(F.col(pred).isin(list(classes)), F.col(pred))
    counts = [F.count_if(inside == c).alias(str(c)) for c in classes]
    return df.groupBy(truth).agg(*counts, F.count_if(inside.isNull()).alias("other"))


def classification_report(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Support, precision and recall per class, with the overall accuracy.

    A missing prediction counts as a wrong one of its row's class; rows
    without a truth are left out. Works on the counts of (truth, prediction)
    pairs, which are few.
    """
    by = list(by)
    pairs = (
        df.filter(F.col(truth).isNotNull())
        .groupBy(*by, F.col(truth).alias("__t"), F.col(pred).alias("__p"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    sides = pairs.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("__t").alias("c"), F.lit(1).alias("t"), F.lit(0).alias("p")),
                F.struct(F.col("__p").alias("c"), F.lit(0).alias("t"), F.lit(1).alias("p")),
            )
        ).alias("__s"),
        F.col("__t").eqNullSafe(F.col("__p")).alias("__hit"),
        "__n",
    ).filter("__s.c IS NOT NULL")
    # Each pair is listed for its truth and its prediction; hits count once, on the truth side.
    per_class = sides.groupBy(*by, F.col("__s.c").alias("class")).agg(
        F.sum(F.col("__s.t") * F.col("__n")).alias("support"),
        F.sum(F.col("__s.p") * F.col("__n")).alias("predicted"),
        F.sum(F.when(F.col("__hit"), F.col("__s.t") * F.col("__n")).otherwise(0)).alias("hits"),
    )
    keys = by or [F.lit(1)]
    overall = pairs.groupBy(*keys).agg(
        F.sum(F.when(F.col("__t").eqNullSafe(F.col("__p")), F.col("__n")).otherwise(0)).alias("__hits"),
        F.sum("__n").alias("__all"),
    )
    accuracy = F.try_divide("__hits", "__all").alias("accuracy")
    if by:
        joined = per_class.join(overall.select(*by, accuracy), by)
    else:
        joined = per_class.withColumn("accuracy", overall.select(accuracy).scalar())
    return joined.select(
        *by,
        "class",
        "support",
        F.try_divide("hits", "predicted").alias("precision"),
        F.try_divide("hits", "support").alias("recall"),
        "accuracy",
    )


def latest_version(df: DataFrame, name: str, version: str, default: int | None = None) -> DataFrame:
    """Highest numeric version per name; ``default`` where no version is a number."""
    number = F.col(version).try_cast("int")
    latest = F.max(number)
    if default is not None:
        latest = F.greatest(F.coalesce(latest, F.lit(default)), F.lit(default))
    return df.groupBy(name).agg(latest.alias("latest_version"))


def compliance_rate(df: DataFrame, pred: str, allowed: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Share of replies within the allowed set; a null reply counts as outside."""
    inside = F.coalesce(F.col(pred).isin(list(allowed)), F.lit(False))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("replies"),
        F.avg(inside.cast("int")).alias("compliance"),
    )


def majority_vote(df: DataFrame, id: str, answer: str) -> DataFrame:
    """Most frequent answer per id, ties by the smaller answer."""
    votes = df.filter(F.col(answer).isNotNull()).groupBy(id, answer).agg(F.count(F.lit(1)).alias("votes"))
    return first_per_key(votes, [id], [F.desc("votes"), F.col(answer)])


def lookup_enrich(
    df: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    payload_col: str | None = None,
    payload_ddl: str | None = None,
) -> DataFrame:
    """Attributes looked up by lower-cased key; null where the name is unknown.

    No broadcast hint is given: Spark broadcasts the dimension when its size
    allows, and else skewed partitions of ``df`` are split. With ``payload_ddl``
    the JSON in ``payload_col`` is parsed into the column ``payload``.
    """
    side = dim.withColumn("__key", F.lower(F.col(dim_key))).drop(dim_key)
    if payload_col:
        side = side.withColumn("payload", F.from_json(F.col(payload_col), payload_ddl)).drop(payload_col)
    keyed = df.withColumn("__key", F.lower(F.col(key)))
    return skew_join(keyed, side, ["__key"], "left").drop("__key")


# Layout of the looked-up payload.
PAYLOAD_DDL = (
    "name STRING, height INT, weight INT, "
    "abilities ARRAY<STRUCT<ability: STRUCT<name: STRING>>>, "
    "types ARRAY<STRUCT<type: STRUCT<name: STRING>>>, "
    "stats ARRAY<STRUCT<stat: STRUCT<name: STRING>, base_stat: INT>>"
)


def flatten_payload(payload: Column) -> list[Column]:
    """Nested lists of a parsed payload as arrays of plain values."""
    return [
        payload["name"].alias("name"),
        payload["height"].alias("height"),
        payload["weight"].alias("weight"),
        F.transform(payload["abilities"], lambda a: a["ability"]["name"]).alias("abilities"),
        F.transform(payload["types"], lambda t: t["type"]["name"]).alias("types"),
        F.transform(payload["stats"], lambda s: s["stat"]["name"]).alias("stat_names"),
        F.transform(payload["stats"], lambda s: s["base_stat"]).alias("stat_values"),
    ]


def nearest_term(df: DataFrame, col: str, terms: DataFrame, term_col: str = "term", max_distance: int = 2) -> DataFrame:
    """Dictionary correction: the nearest term within ``max_distance`` edits, as ``nearest``.

    Works on distinct words. Most words are right and found by an equi-join;
    the others walk tries of the terms (:mod:`corpusloom.operators.term_trie`).
    Ties go to the smaller term; null when no term is near enough.
    """
    lowered = F.lower(F.col(col))
    words = df.filter(F.col(col).isNotNull()).select(lowered.alias("__word")).distinct()
    term = terms.filter(F.col(term_col).isNotNull()).groupBy(F.lower(F.col(term_col)).alias("term")).agg(F.min(term_col).alias("nearest"))
    looked_up = words.join(term, F.col("__word") == F.col("term"), "left")
    right = looked_up.filter("term is not null").select("__word", "nearest", F.lit(0).alias("distance"))
    wrong = looked_up.filter("term is null").select(F.col("__word").alias("word"))
    corrected = nearest_terms(wrong, term, max_distance).withColumnRenamed("word", "__word")
    best = right.unionByName(corrected)
    return skew_join(df.withColumn("__word", lowered), best, ["__word"], "left").drop("__word")


def append_chunks(*frames: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
