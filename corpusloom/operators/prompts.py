"""Prompt building."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def instruct(instruction: str, text: Column) -> Column:
    """Instruction and text put together, with nothing in between."""
    return F.concat(F.lit(instruction), text)


def render_prompt(template: str, *cols: str, **values: Column) -> Column:
    """Fill ``{name}`` places of a template with columns; a null gives a null prompt."""
    known = {c: F.col(c).cast("string") for c in cols}
    known.update({name: value.cast("string") for name, value in values.items()})
    parts: list[Column] = []
    for n, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if n % 2:
            if piece not in known:
                raise ValueError(f"no column for {{{piece}}}")
            parts.append(known[piece])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def few_shot_prompt(
    instruction: str,
    examples: DataFrame,
    reminder: str,
    order: str = "pos",
    example: str = "example",
    sep: str = "\n",
    most_examples: int | None = None,
) -> Column:
    """Instruction, ordered examples and a closing reminder, as a scalar subquery.

    The examples are collected once into one string, as every prompt holds all
    of them. With ``most_examples`` a longer list fails the job.
    """
    listed = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct(order, example))), lambda e: e[example]), sep
    )
    parts = [F.lit(instruction), F.nullif(listed, F.lit("")), F.lit(reminder)]
    if most_examples is not None:
        few = F.assert_true(F.count(F.lit(1)) <= most_examples, F.lit("too many examples for one prompt"))
        # assert_true is null when it holds; concat_ws leaves nulls out.
        parts.append(few.cast("string"))
    return examples.agg(F.concat_ws(sep, *parts).alias("prompt")).scalar()
