"""SQL scalar and table functions kept in a catalogue table."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
SCHEMA = "schema STRING, name STRING, args STRING, returns STRING, comment STRING, body STRING"


@dataclass(frozen=True)
class SqlFunction:
    """A function in SQL text: ``returns`` is a type, or ``TABLE(name type, ..)``."""

    name: str
    args: str
    returns: str
    comment: str
    body: str
    schema: str = "default"


def registry(spark: SparkSession, functions: list[SqlFunction]) -> DataFrame:
    """The catalogue of functions as a DataFrame, to be stored as a table."""
    rows = [asdict(f) for f in functions]
    return spark.createDataFrame([tuple(r[c] for c in ("schema", "name", "args", "returns", "comment", "body")) for r in rows], SCHEMA)


def list_functions(catalogue: DataFrame, schema: str | None = None) -> DataFrame:
    """Functions of a schema with comments, as offered to an agent."""
    if schema is not None:
        catalogue = catalogue.filter(F.col("schema") == schema)
    return catalogue.select("schema", "name", "args", "returns", "comment").orderBy("schema", "name")


def register_functions(spark: SparkSession, functions: list[SqlFunction] | DataFrame) -> list[str]:
    """Create the functions as temporary SQL functions of the session; returns their names.

    A catalogue table is read by the driver, which has to run one statement
    per function in any case.
    """
    if isinstance(functions, DataFrame):
        functions = [SqlFunction(**row.asDict()) for row in functions.collect()]
    for f in functions:
        if not _IDENTIFIER.fullmatch(f.name):
            raise ValueError(f"not a plain identifier: {f.name!r}")
        comment = f.comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {f.name}({f.args}) RETURNS {f.returns} "
            f"COMMENT '{comment}' RETURN {f.body}"
        )
    return [f.name for f in functions]


def describe_function(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE FUNCTION EXTENDED {name}")
