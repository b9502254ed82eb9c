"""Batch inference over a table with an interchangeable model backend."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from hashlib import md5
from uuid import uuid4

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.prompts import render_prompt
from corpusloom.operators.structured import parse_reply
from corpusloom.plans.skew import skew_join
from corpusloom.plans.workspace import complete_folders, materialize

# Fixed value: prompts per backend call unless told otherwise.
BATCH_SIZE = 150

Backend = Callable[[list[str]], Sequence[str]]


def retrying(backend: Backend, attempts: int = 3, wait: float = 1.0) -> Backend:
    """Repeat a failed call with growing waits, then let the error through."""

    def call(prompts: list[str]) -> Sequence[str]:
        for attempt in range(attempts):
            try:
                return backend(prompts)
            except Exception:
                if attempt + 1 == attempts:
                    raise
                time.sleep(wait * 2**attempt)
        return []

    return call


def _answer(prompts: DataFrame, backend: Backend, batch_size: int, on_error: str) -> DataFrame:
    """``__key, __reply`` for distinct prompts; one Python step in the plan."""
    if on_error not in ("fail", "null"):
        raise ValueError("on_error is 'fail' or 'null'")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            texts = frame["__prompt"].tolist()
            replies: list[str | None] = []
            for start in range(0, len(texts), batch_size):
                part = texts[start : start + batch_size]
                try:
                    got: list[str | None] = list(backend(part))
                    if len(got) != len(part):
                        raise ValueError(f"backend returned {len(got)} replies for {len(part)} prompts")
                except Exception:
                    if on_error == "fail":
                        raise
                    got = [None] * len(part)
                replies.extend(got)
            yield pd.DataFrame({"__key": frame["__key"], "__reply": pd.Series(replies, dtype=object, index=frame.index)})

    return prompts.mapInPandas(run, "__key string, __reply string")


def infer(
    df: DataFrame,
    prompt_col: str,
    backend: Backend,
    out_col: str = "reply",
    response_ddl: str | None = None,
    enums: dict[str, Sequence] | None = None,
    required: Sequence[str] = (),
    batch_size: int = BATCH_SIZE,
    on_error: str = "fail",
    store: str | None = None,
    model: str | None = None,
) -> DataFrame:
    """Add the backend's reply to every row.

    Each distinct prompt is asked once, however many rows share it, and the
    replies are joined back by prompt hash; a hot prompt's partition is split. With
    ``store`` (a path) replies are kept there by ``model`` (name and version,
    then required), response schema and prompt: what was answered is not asked
    again, by a later action, run or retry. With
    ``response_ddl`` the reply is parsed and checked (columns of
    :func:`~corpusloom.operators.structured.parse_reply`).
    """
    if store is not None and not model:
        raise ValueError("a store needs the name of the model")
    keyed = df.withColumn("__key", F.md5(F.col(prompt_col)))
    # Prompts are the grouping key: a hash table holds them, where the first of each hash would have all rows sorted.
    asked = keyed.filter("__key is not null").select(F.col(prompt_col).alias("__prompt"), "__key").distinct()
    if store is None:
        replies = _answer(asked, backend, batch_size, on_error)
    else:
        kind = md5(f"{len(model)}:{model}{response_ddl or ''}".encode()).hexdigest()
        replies = _stored_answers(asked, backend, batch_size, on_error, f"{store}/{kind}")
    joined = skew_join(keyed, replies, ["__key"], "left")
    out = joined.withColumnRenamed("__reply", out_col).drop("__key")
    if response_ddl:
        out = parse_reply(out, out_col, response_ddl, enums or {}, required)
    return out


def _stored_answers(asked: DataFrame, backend: Backend, batch_size: int, on_error: str, folder: str) -> DataFrame:
    """Answer what the folder lacks, add it as a subfolder of this call, and read what is asked.

    Each call reads a list of folders of its own. Spark takes two reads of one
    path in a query for the same, even if files were added in between.
    """
    spark = asked.sparkSession
    schema, fresh_keys, known = "__key string, __reply string", asked, complete_folders(spark, folder)
    if known:
        fresh_keys = asked.join(spark.read.schema(schema).parquet(*known).select("__key"), "__key", "left_anti")
    # Failed calls are not stored, so that a later run asks them again.
    fresh = _answer(fresh_keys, backend, batch_size, on_error).filter(F.col("__reply").isNotNull())
    added = f"{folder}/{uuid4().hex}"
    fresh.write.parquet(added)
    # Only what is asked here; two runs at a time may both answer a prompt: keep one reply per key.
    answers = spark.read.schema(schema).parquet(*known, added).join(asked.select("__key"), "__key", "left_semi")
    return answers.groupBy("__key").agg(F.min("__reply").alias("__reply"))


def generate(df: DataFrame, template: str, backend: Backend, out_col: str = "answer", **options) -> DataFrame:
    """Fill the template from the row's columns and ask the backend."""
    names = re.findall(r"\{(\w+)\}", template)
    asked = df.withColumn("__asked", render_prompt(template, *names))
    return infer(asked, "__asked", backend, out_col, **options).drop("__asked")


def compare_models(
    df: DataFrame, prompt_col: str, backends: dict[str, Backend], truth: str, **options
) -> DataFrame:
    """The same rows answered by several backends: ``model, truth, pred`` in long form.

    Feed it to ``classification_report`` and ``compliance_rate`` by model.
    """
    out = None
    for name, backend in backends.items():
        answered = infer(df, prompt_col, backend, "pred", model=name, **options).select(
            F.lit(name).alias("model"), F.col(truth).alias("truth"), "pred"
        )
        out = answered if out is None else out.unionByName(answered)
    return out


def retry_rejected(
    df: DataFrame,
    prompt_col: str,
    backend: Backend,
    out_col: str,
    response_ddl: str,
    enums: dict,
    required: Sequence[str],
    store: str | None = None,
    model: str | None = None,
) -> DataFrame:
    """Ask once more for the rows whose reply was rejected; ``df`` comes from ``infer`` with a DDL.

    The first answers are written to shared storage, as both the accepted and
    the rejected rows are read from them. With ``store`` the second answers are
    kept under the model's name with a mark, apart from the rejected first ones.
    """
    df = materialize(df, "answers")
    source = [c for c in df.columns if c not in (out_col, "parsed", "valid", "reasons")]
    again = infer(
        df.filter(~F.col("valid")).select(*source),
        prompt_col,
        backend,
        out_col,
        response_ddl=response_ddl,
        enums=enums,
        required=required,
        store=store,
        model=f"{model} (retry)" if model else None,
    )
    return df.filter(F.col("valid")).unionByName(again)
