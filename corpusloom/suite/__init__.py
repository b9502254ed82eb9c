"""Registered queries over the test tables, each with its oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Suite:
    """A set of named queries and their oracle SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.oracles[fn.__name__] = sql.strip()
            return fn

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def all_suites() -> list[Suite]:
    from corpusloom.suite import (
        conversations,
        corpus,
        evaluation,
        inference,
        relational,
        retrieval,
        streams,
        textual,
    )

    modules = (relational, corpus, retrieval, inference, textual, conversations, evaluation, streams)
    return [m.suite for m in modules]
