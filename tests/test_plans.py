"""Physical plans: what is read, shuffled and run in Python."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corpusloom.operators import inference, relational as rel
from corpusloom.suite import all_suites

QUERIES = {name: query for suite in all_suites() for name, query in suite.queries.items()}


def test_unwanted_columns_are_not_read(spark, sf):
    plan = plan_of(QUERIES["snapshot_columns"](spark, sf))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan
    assert "PushedFilters: [IsNotNull(url)]" in plan


def test_two_columns_of_sixteen(spark, sf):
    plan = plan_of(QUERIES["top_locations"](spark, sf))
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "TakeOrderedAndProject" in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize(
    "name",
    ["page_texts", "page_chunks", "document_windows", "document_chunks", "sentence_chunks", "merged_sections", "summaries",
     "grammar_rules", "masked_entities", "extracted_entities", "readability", "token_counts"],
)
def test_text_work_is_narrow_and_native(spark, sf, name):
    """No shuffle by key, no sort and no Python: only the spreading of the single test file."""
    plan = plan_of(QUERIES[name](spark, sf))
    assert "hashpartitioning" not in plan and "Sort " not in plan and "Python" not in plan and "InPandas" not in plan


def test_inference_scans_twice_and_asks_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    plan = plan_of(inference.infer(docs, "text", lambda texts: texts))
    assert plan.count("MapInPandas") == 1
    assert plan.count("FileScan parquet") == 2


def test_python_is_left_to_backends(spark, sf):
    with_python = {
        name
        for name in QUERIES
        if name not in ("streamed_index", "two_sources", "streamed_files", "overwrite_sink", "csv_round_trip", "accepted_and_rejected",
                        "streamed_table", "retried_replies", "index_syncs", "merged_index")
        and any(mark in plan_of(QUERIES[name](spark, sf)) for mark in ("EvalPython", "InPandas", "InArrow"))
    }
    assert with_python == {
        "nearest_exact", "nearest_in_cells", "recall_in_cells", "nearest_class", "retrieved_documents", "context_prompts",
        "trained_cells", "retrieved_in_cells", "retrieved_by_codes", "recall_by_codes",
        "text_search", "text_embeddings", "checked_replies", "reply_numbers", "model_scores",
        "model_compliance", "generated_answers", "sql_inference", "sql_more_functions", "corrected_names",
    }


def test_counts_are_partial_before_the_shuffle(spark, sf):
    for name in ("event_type_counts", "reply_compliance", "label_scores", "majority_event"):
        plan = plan_of(QUERIES[name](spark, sf))
        assert "partial_count" in plan


def test_correction_varies_wrong_words_only(spark):
    terms = spark.createDataFrame([("Alpha",), ("Beta",)], "term string")
    df = spark.createDataFrame([("alpha",), ("Betta",), ("zzzzzz",), (None,)], "w string")
    got = {r["w"]: (r["nearest"], r["distance"]) for r in rel.nearest_term(df, "w", terms).collect()}
    assert got == {"alpha": ("Alpha", 0), "Betta": ("Beta", 1), "zzzzzz": (None, None), None: (None, None)}


def test_sampling_needs_no_shuffle(spark, sf):
    from corpusloom.sources.tables import hash_sample

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert "Exchange" not in plan_of(hash_sample(docs, "doc_id", 0.5))
    assert hash_sample(docs, "doc_id", 1.0).count() == docs.count()
    assert docs.filter(F.col("doc_id") < 0).isEmpty()
