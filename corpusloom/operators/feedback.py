"""Merging reviewer feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.relational import latest_per_key


def deduplicate_assessments(df: DataFrame, mode: str = "fixed", list_limit: int | None = None) -> DataFrame:
    """Latest text assessment joined with the collected retrieval assessments.

    Columns: ``request_id, source, timestamp, text_assessment, schema_version,
    retrieval_assessments``; ``source`` is a struct with the reviewer's ``id``.

    ``compat`` keeps the known traps of the original job: one text per request
    (an older one of a second reviewer is lost), one output row per reviewed
    step, and null keys on rows that have retrieval assessments only.
    ``fixed`` keeps the latest text per request and reviewer, collects over
    steps and fills the keys from either side.

    A group gives one row with its whole list. With ``list_limit`` a longer
    list fails the job, for callers that cannot hold one.
    """
    if mode not in ("fixed", "compat"):
        raise ValueError("mode is 'fixed' or 'compat'")
    reviewed = df.withColumn("__reviewer", F.col("source.id"))
    text_keys = ["request_id"] if mode == "compat" else ["request_id", "__reviewer"]
    texts = latest_per_key(
        reviewed.filter("text_assessment is not null").drop("retrieval_assessment"),
        text_keys,
        ["timestamp"],
        ["__reviewer", "step_id", "text_assessment"],
    ).drop("step_id")

    list_keys = ["request_id", "__reviewer"] + (["step_id"] if mode == "compat" else [])
    collected = F.sort_array(F.collect_list("retrieval_assessment"))
    if list_limit is not None:
        fits = F.assert_true(F.count(F.lit(1)) <= list_limit, F.lit(f"more than {list_limit} retrieval assessments in a group"))
        collected = F.when(fits.isNull(), collected)
    lists = (
        reviewed.filter("retrieval_assessment is not null")
        .groupBy(*list_keys)
        .agg(collected.alias("retrieval_assessments"))
        .select(F.col("request_id").alias("__r_request"), F.col("__reviewer").alias("__r_reviewer"), "retrieval_assessments")
    )
    merged = texts.join(
        lists,
        (texts["request_id"] == lists["__r_request"]) & (texts["__reviewer"] == lists["__r_reviewer"]),
        "full",
    )
    request, source = F.col("request_id"), F.col("source")
    if mode == "fixed":
        request = F.coalesce(request, F.col("__r_request"))
        source = F.coalesce(source, F.when(F.col("__r_reviewer").isNotNull(), F.struct(F.col("__r_reviewer").alias("id"))))
    return merged.select(
        request.alias("request_id"),
        source.alias("source"),
        "timestamp",
        "text_assessment",
        "schema_version",
        "retrieval_assessments",
    )
