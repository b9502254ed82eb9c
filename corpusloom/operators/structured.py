"""Parsing and checking structured replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_number(reply: Column, path: str) -> Column:
    """Whole number at a JSON path; null where it is missing or no number."""
    return F.get_json_object(reply, path).try_cast("bigint")


def parse_reply(
    df: DataFrame, col: str, ddl: str, enums: dict[str, Sequence] | None = None, required: Sequence[str] = ()
) -> DataFrame:
    """Add ``parsed`` (struct), ``valid`` and ``reasons`` (array of strings).

    A reply is invalid when it is no JSON object, lacks a required field, has
    a value outside its enum, or a value of another type than declared.
    """
    enums = enums or {}
    schema = StructType.fromDDL(ddl)
    parsed = F.from_json(F.col(col), schema)
    is_json = F.coalesce(F.col(col).rlike(r"^\s*\{") & F.try_parse_json(F.col(col)).isNotNull(), F.lit(False))
    checks = [F.when(~is_json, "not a JSON object")]
    for field in schema.fields:
        value = F.col(f"parsed.`{field.name}`")
        raw = F.get_json_object(F.col(col), f"$['{field.name}']")
        if field.name in required:
            checks.append(F.when(is_json & raw.isNull(), f"missing {field.name}"))
        checks.append(F.when(is_json & raw.isNotNull() & value.isNull(), f"wrong type of {field.name}"))
        if field.name in enums:
            allowed = list(enums[field.name])
            checks.append(F.when(value.isNotNull() & ~value.isin(allowed), f"{field.name} outside its values"))
    reasons = F.array_compact(F.array(*checks))
    return (
        df.withColumn("parsed", parsed)
        .withColumn("reasons", reasons)
        .withColumn("valid", F.size("reasons") == 0)
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of a checked table.

    Both read ``df``: write answers of a model first (``materialize``, or the
    ``store`` of ``infer``), or they are asked for twice.
    """
    return df.filter(F.col("valid")), df.filter(~F.col("valid"))


def parse_jsonl(df: DataFrame, col: str, ddl: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of a JSON-lines reply: ``keep, line_no, line, parsed, valid``.

    Code fences, blank lines and trailing commas are removed first. A line
    that is no JSON object has ``valid`` false and a null ``parsed``.
    """
    lines = F.filter(
        F.transform(
            F.split(F.col(col), r"\r?\n"), lambda s: F.regexp_replace(F.btrim(s, F.lit(" \t\r,")), r"^```.*$", "")
        ),
        lambda s: s != "",
    )
    rows = df.select(*keep, F.posexplode(lines).alias("line_no", "line"))
    valid = F.col("line").rlike(r"^\s*\{") & F.try_parse_json(F.col("line")).isNotNull()
    return rows.withColumn("valid", valid).withColumn("parsed", F.when(F.col("valid"), F.from_json("line", ddl)))


def split_multi(col: Column, sep: str = ",") -> Column:
    """Distinct trimmed values of a delimited text, in order of appearance."""
    parts = F.transform(F.split(col, rf"\Q{sep}\E"), lambda s: F.trim(s))
    return F.array_distinct(F.filter(parts, lambda s: s != ""))
