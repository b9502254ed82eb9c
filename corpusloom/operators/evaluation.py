"""Evaluation sets and measures.

The measures are countable proxies for what a judge model would be asked:
word overlap with the truth, the context or the question, precision and
recall of the retrieved ids, and the share of rows labelled toxic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import let, words
from corpusloom.operators.baselines import summarize
from corpusloom.operators.prompts import render_prompt

MEASURES = ("correctness", "groundedness", "relevance", "retrieval_precision", "retrieval_recall", "toxicity")


def build_eval_set(
    docs: DataFrame, n: int, template: str, content: str = "content", doc_uri: str = "doc_uri", seed: int = 0
) -> DataFrame:
    """``n`` documents in hash order with a question made by template and the source.

    Template places: ``{topic}`` (the most telling sentence of the content, by
    :func:`~corpusloom.operators.baselines.summarize`) and ``{doc_uri}``. Only
    the picked documents are summarised.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(doc_uri), F.lit("|"), F.col(content)))
    topic = summarize(F.col(content), 1)
    keyed = docs.select(content, doc_uri).withColumn("__order", order)
    picked = keyed.orderBy("__order", doc_uri).limit(n)
    return picked.select(
        F.col("__order").alias("request_id"),
        render_prompt(template, topic=topic, doc_uri=F.col(doc_uri)).alias("question"),
        F.col(content).alias("expected_context"),
        F.col(doc_uri).alias("source"),
    )


def token_f1(answer: Column, truth: Column) -> Column:
    """Harmonic mean of precision and recall between the distinct words of two texts."""

    def score(x: Column) -> Column:
        shared = F.size(F.array_intersect(x["a"], x["b"]))
        return F.coalesce(F.try_divide(2.0 * shared, F.size(x["a"]) + F.size(x["b"])), F.lit(0.0))

    return let(_word_sets(answer, truth), score)


def coverage(part: Column, whole: Column) -> Column:
    """Share of the distinct words of ``part`` found in ``whole``."""

    def score(x: Column) -> Column:
        shared = F.size(F.array_intersect(x["a"], x["b"]))
        return F.coalesce(F.try_divide(1.0 * shared, F.size(x["a"])), F.lit(0.0))

    return let(_word_sets(part, whole), score)


def _word_sets(a: Column, b: Column) -> Column:
    def word_set(text: Column) -> Column:
        return F.array_distinct(words(F.coalesce(text, F.lit(""))))

    return F.struct(word_set(a).alias("a"), word_set(b).alias("b"))


def evaluate(
    df: DataFrame,
    measures: Sequence[str] = MEASURES,
    question: str = "question",
    answer: str = "answer",
    truth: str = "expected_response",
    context: str = "context",
    retrieved: str = "retrieved_ids",
    expected: str = "expected_ids",
    toxic: str = "toxic",
) -> DataFrame:
    """The rows with one column per measure."""

    def shared_ids() -> Column:
        return 1.0 * F.size(F.array_intersect(F.col(retrieved), F.col(expected)))

    built = {
        "correctness": lambda: token_f1(F.col(answer), F.col(truth)),
        "groundedness": lambda: coverage(F.col(answer), F.col(context)),
        "relevance": lambda: coverage(F.col(question), F.col(answer)),
        "retrieval_precision": lambda: F.try_divide(shared_ids(), F.size(F.array_distinct(F.col(retrieved)))),
        "retrieval_recall": lambda: F.try_divide(shared_ids(), F.size(F.array_distinct(F.col(expected)))),
        "toxicity": lambda: F.col(toxic).cast("double"),
    }
    unknown = set(measures) - set(built)
    if unknown:
        raise ValueError(f"unknown measures: {sorted(unknown)}")
    return df.select("*", *[built[m]().alias(m) for m in measures])


def summarize_run(evaluated: DataFrame, measures: Sequence[str] = MEASURES, by: Sequence[str] = ()) -> DataFrame:
    """Row count and mean of each measure, per run when ``by`` is given."""
    present = [m for m in measures if m in evaluated.columns]
    return evaluated.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *[F.avg(m).alias(m) for m in present])


def reading_ease(text: Column) -> Column:
    """Flesch reading ease of English text; syllables are counted as vowel groups.

    Fixed values: 206.835, 1.015 and 84.6 of the published formula.
    """
    n_words = F.regexp_count(text, F.lit(r"[A-Za-z]+"))
    n_sentences = F.greatest(F.regexp_count(text, F.lit(r"[.!?]+")), F.lit(1))
    n_syllables = F.regexp_count(F.lower(text), F.lit(r"[aeiouy]+"))
    return (
        F.lit(206.835)
        - 1.015 * F.try_divide(n_words.cast("double"), n_sentences.cast("double"))
        - 84.6 * F.try_divide(n_syllables.cast("double"), n_words.cast("double"))
    )
