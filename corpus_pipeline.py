"""A training corpus from ``documents`` in five stages, each written as Parquet before the next one reads it.

Toxic documents go, one document of each near-duplicate group stays, documents
that hold benchmark items go, sources are mixed to target weights, and what is
left is dealt into shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontamination, mixing, sharding, similar_texts, toxicity
from corpusloom.llm.suite import TOXIC_FROM
from corpusloom.plans.workspace import fresh_path
from corpusloom.suite import table

# Texts go to Python tasks in Arrow batches; both sides hold a batch beside Spark's own memory, so batches are bounded in bytes.
ARROW_BATCHES = {"maxRecordsPerBatch": "1000", "maxBytesPerBatch": str(4 << 20)}


def small_batches(spark: SparkSession) -> None:
    for name, value in ARROW_BATCHES.items():
        spark.conf.set(f"spark.sql.execution.arrow.{name}", value)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the bound."""
    small_batches(spark)
    training = toxicity.Training()
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", training.sample_rows), training)
    return docs.filter(toxicity.score_column(model, F.col("text")) < TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of texts alike in five-word shingles or in fingerprint."""
    small_batches(spark)
    return similar_texts.keep_first_similar(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    small_batches(spark)
    flagged = decontamination.flag_documents(docs, table(spark, sf_dir, "benchmark"), flag="__contaminated")
    return flagged.filter(~F.col("__contaminated")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out so that sources meet their target weights."""
    return mixing.mix_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document of the mix."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Stages with a fitted model, fingerprints and edit distances have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; every stage's result is written in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
