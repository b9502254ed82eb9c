"""Model calls written in SQL and answered once for the whole table.

A UDF sees one Arrow batch, so ``ai_query`` can only spare repeated prompts
within it. Here a query says what to ask (``ai_request``, a plain SQL function
that builds a request) and :func:`answer_requests` asks each distinct request of
the whole result once and puts the replies in the requests' places.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.model_sql import Backend, batch_asker
from corpusloom.functions.registry import SqlFunction, register_functions
from corpusloom.operators.inference import BATCH_SIZE
from corpusloom.plans.skew import skew_join
from corpusloom.plans.workspace import materialize

FIELDS = ("model_endpoint", "model_request", "model_format")


def register_requests(spark: SparkSession) -> list[str]:
    """Create ``ai_request(endpoint, request, responseFormat => ..)``, which takes the arguments of ``ai_query``."""
    values = ", ".join(f"'{field}', {value}" for field, value in zip(FIELDS, ("endpoint", "request", "responseFormat")))
    kinds = ", ".join(f"{field}: STRING" for field in FIELDS)
    function = SqlFunction(
        "ai_request", "endpoint STRING, request STRING, responseFormat STRING DEFAULT NULL", f"STRUCT<{kinds}>",
        "A request to a model, answered once per distinct one.", f"named_struct({values})",
    )
    return register_functions(spark, [function])


def request_columns(df: DataFrame) -> list[str]:
    """Top-level columns that hold requests."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StructType) and tuple(f.dataType.names) == FIELDS]


def _key(request: Column) -> Column:
    # JSON leaves null fields out and quotes the others, so no two requests share a text.
    return F.when(request["model_request"].isNotNull(), F.sha2(F.to_json(request), 256))


def distinct_requests(df: DataFrame, columns: list[Column]) -> DataFrame:
    """``__key, __request``: each request of the columns once.

    The fields are grouping keys, so that a task holds distinct requests in a
    hash table; keeping the first of a key's would sort all of its rows.
    """
    fields = df.select(F.explode(F.array(*columns)).alias("__request")).select("__request.*").filter("model_request is not null")
    request = F.struct(*FIELDS)
    return fields.distinct().select(_key(request).alias("__key"), request.alias("__request"))


def answer_requests(df: DataFrame, backends: dict[str, Backend], batch_size: int = BATCH_SIZE) -> DataFrame:
    """``df`` with the reply (a string) in place of each request, names and order of columns unchanged.

    Equal requests of any rows and request columns are asked once. The calls
    run when this function is called and their replies are written to shared
    storage, so that no later action repeats them. One exchange carries prompts,
    that which finds the distinct ones; rows meet replies by hash, and the
    partition of a hot request is split. A null request has a null reply, as has
    one that the model answers with null; an unknown endpoint fails. A table
    without request columns is returned as it is. Column names must be distinct.
    """
    names = request_columns(df)
    if not names:
        return df
    quoted = {name: F.col(f"`{name.replace('`', '``')}`") for name in df.columns}
    if len(quoted) < len(df.columns):
        raise ValueError("column names are not distinct")
    distinct = distinct_requests(df, [quoted[name] for name in names])
    ask = batch_asker(backends, batch_size)

    @F.pandas_udf("string")
    def replies(endpoints: pd.Series, prompts: pd.Series, formats: pd.Series) -> pd.Series:
        return ask(endpoints, prompts, formats)

    asked = distinct.select("__key", replies.asNondeterministic()(*[F.col("__request")[f] for f in FIELDS]).alias("__reply"))
    answers = materialize(asked, "model-replies")

    keys = {name: f"__key_{place}" for place, name in enumerate(names)}
    keyed = df.select(*[_key(column).alias(keys[name]) if name in keys else column for name, column in quoted.items()])

    def joined(rows: DataFrame, key: str) -> DataFrame:
        found = answers.select(F.col("__key").alias(key), F.col("__reply").alias(f"{key}_reply"))
        return skew_join(rows, found, [key], "left")

    rows = reduce(joined, keys.values(), keyed)
    return rows.select(*[F.col(f"{keys[n]}_reply").alias(n) if n in keys else c for n, c in quoted.items()])
