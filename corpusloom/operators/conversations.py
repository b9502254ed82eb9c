"""Conversations as rows or as message lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.skew import skew_join

# Shape of a tool call within a message.
TOOL_CALLS_DDL = "ARRAY<STRUCT<id: STRING, function: STRUCT<name: STRING, arguments: STRING>>>"


def assemble_messages(
    df: DataFrame,
    system_prompt: str | None = None,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    most_messages: int | None = None,
) -> DataFrame:
    """Ordered list of ``turn, role, content`` per conversation, the system prompt first with a null turn.

    A conversation is one list. With ``most_messages`` a longer one fails the
    job, for callers that cannot hold one.
    """
    listed = F.sort_array(
        F.collect_list(F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content")))
    )
    if most_messages is not None:
        fits = F.assert_true(F.count(F.lit(1)) <= most_messages, F.lit(f"more than {most_messages} messages in a conversation"))
        listed = F.when(fits.isNull(), listed)
    messages = F.col("__m")
    if system_prompt is not None:
        kind = df.schema[turn].dataType
        first = F.struct(F.lit(None).cast(kind).alias("turn"), F.lit("system").alias("role"), F.lit(system_prompt).alias("content"))
        messages = F.concat(F.array(first), messages)
    return df.groupBy(conv).agg(listed.alias("__m")).select(conv, messages.alias("messages"))


def _last(df: DataFrame, conv: str, turn: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(conv).agg(F.max_by(F.struct(*columns), F.col(turn)).alias("__last"))


def route(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", tool_calls: str = "tool_calls"
) -> DataFrame:
    """``continue`` where the last message calls tools, else ``end``."""
    last = _last(df.withColumn("__calls", _call_count(F.col(tool_calls))), conv, turn, ["__calls"])
    return last.select(conv, F.when(F.col("__last.__calls") > 0, "continue").otherwise("end").alias("next_step"))


def _call_count(tool_calls: Column) -> Column:
    return F.coalesce(F.json_array_length(tool_calls), F.lit(0))


def dispatch_tools(
    df: DataFrame,
    tools: dict[str, DataFrame],
    arguments: str | Sequence[str] | dict[str, str | Sequence[str]],
    conv: str = "conv_id",
    turn: str = "turn",
    tool_calls: str = "tool_calls",
) -> DataFrame:
    """Answer the calls of each conversation's last message: one ``tool`` message per call.

    A tool is a table looked up by the call's ``arguments``: their names, for
    all tools or by tool. A single argument is met by the column ``key``,
    several by the columns of their names; other columns are the answer. Keys
    are compared in lower case; of rows with one key the smallest answer
    counts. Unknown tools and keys give a null content. Rows: ``conv, turn,
    role, tool_call_id, content``.
    """
    if not tools:
        raise ValueError("no tools")
    names = {}
    for name in tools:
        wanted = arguments[name] if isinstance(arguments, dict) else arguments
        names[name] = [wanted] if isinstance(wanted, str) else list(wanted)

    def key_of(values: Sequence[Column]) -> Column:
        # As JSON, a null is told apart from other values.
        return F.to_json(F.array(*[F.lower(v.cast("string")) for v in values]))

    answers = None
    for name, table in tools.items():
        keys = ["key"] if len(names[name]) == 1 and names[name][0] not in table.columns else names[name]
        part = table.select(
            F.lit(name).alias("__tool"),
            key_of([F.col(k) for k in keys]).alias("__key"),
            result_text(F.struct(*[c for c in table.columns if c not in keys])).alias("content"),
        )
        answers = part if answers is None else answers.unionByName(part)
    answers = answers.groupBy("__tool", "__key").agg(F.min("content").alias("content"))
    call_name, call_arguments = F.col("__call.function.name"), F.col("__call.function.arguments")
    key = F.lit(None).cast("string")
    for name, wanted in names.items():
        values = key_of([F.get_json_object(call_arguments, f"$['{a}']") for a in wanted])
        key = F.when(call_name == name, values).otherwise(key)
    calls = (
        _last(df, conv, turn, [turn, tool_calls])
        .select(
            conv,
            F.col(f"__last.{turn}").alias("__turn"),
            F.posexplode(F.from_json(F.col(f"__last.{tool_calls}"), TOOL_CALLS_DDL)).alias("__pos", "__call"),
        )
        .select(
            conv,
            (F.col("__turn") + F.col("__pos") + 1).alias(turn),
            F.lit("tool").alias("role"),
            F.col("__call.id").alias("tool_call_id"),
            call_name.alias("__tool"),
            key.alias("__key"),
        )
    )
    # All tools in one table: the calls are found once and looked up once.
    answered = skew_join(calls, answers, ["__tool", "__key"])
    return answered.select(conv, turn, "role", "tool_call_id", "content")


def result_text(result: Column) -> Column:
    """Tool result as JSON text."""
    return F.to_json(result)


def final_answer(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Role and text of the last message."""
    last = _last(df, conv, turn, [role, text])
    return last.select(conv, F.col(f"__last.{role}").alias("last_role"), F.col(f"__last.{text}").alias("answer"))


def flatten_updates(df: DataFrame, id_cols: Sequence[str], messages: str = "messages") -> DataFrame:
    """Message lists back to one row per message, with the fields of the message and its place ``pos`` in the list."""
    return df.select(*id_cols, F.posexplode(messages).alias("pos", "__m")).select(*id_cols, "pos", "__m.*")
