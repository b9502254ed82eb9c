"""Conversations: message lists, routing, tool calls and answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import conversations as conv
from corpusloom.suite import Suite, table

suite = Suite()


@suite.add("""
SELECT conv_id, CAST(count(*) + 1 AS INT) AS messages,
       md5('system: Be brief.' || chr(10) || string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS digest
FROM conversations GROUP BY conv_id
""")
def message_lists(spark, sf):
    listed = conv.assemble_messages(table(spark, sf, "conversations"), "Be brief.")
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
    return listed.select("conv_id", F.size("messages").alias("messages"), F.md5(lines).alias("digest"))


@suite.add("SELECT conv_id, turn, role, md5(text) AS digest FROM conversations")
def flattened_messages(spark, sf):
    listed = conv.assemble_messages(table(spark, sf, "conversations"))
    flat = conv.flatten_updates(listed, ["conv_id"])
    return flat.select("conv_id", "turn", "role", F.md5("content").alias("digest"))


def _with_calls(spark, sf):
    """Every user message calls two tools: a known one for a nation, and an unknown one."""
    nation = F.concat(F.lit("nation_"), (F.col("conv_id") % 25).cast("string"))
    calls = F.format_string(
        '[{"id": "c%d-1", "function": {"name": "nation_lookup", "arguments": "{\\"name\\": \\"%s\\"}"}}, '
        '{"id": "c%d-2", "function": {"name": "no_such_tool", "arguments": "{\\"name\\": \\"%s\\"}"}}]',
        "conv_id",
        nation,
        "conv_id",
        nation,
    )
    return table(spark, sf, "conversations").withColumn("tool_calls", F.when(F.col("role") == "user", calls))


@suite.add("""
SELECT conv_id, CASE WHEN arg_max(role, turn) = 'user' THEN 'continue' ELSE 'end' END AS next_step
FROM conversations GROUP BY conv_id
""")
def next_steps(spark, sf):
    return conv.route(_with_calls(spark, sf))


@suite.add("""
WITH l AS (SELECT conv_id, max(turn) AS turn FROM conversations GROUP BY conv_id HAVING arg_max(role, turn) = 'user')
SELECT conv_id, turn + 1 AS turn, 'tool' AS role, 'c' || conv_id || '-1' AS tool_call_id,
       '{"n_nationkey":' || n_nationkey || ',"r_name":"' || r_name || '"}' AS content
FROM l LEFT JOIN nation ON lower(n_name) = 'nation_' || (conv_id % 25) LEFT JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT conv_id, turn + 2, 'tool', 'c' || conv_id || '-2', NULL FROM l
""")
def tool_answers(spark, sf):
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    tool = nation.select(F.col("n_name").alias("key"), "n_nationkey", "r_name")
    return conv.dispatch_tools(_with_calls(spark, sf), {"nation_lookup": tool}, "name")


@suite.add("""
SELECT conv_id, arg_max(role, turn) AS last_role, md5(arg_max(text, turn)) AS digest FROM conversations GROUP BY conv_id
""")
def final_answers(spark, sf):
    last = conv.final_answer(table(spark, sf, "conversations"))
    return last.select("conv_id", "last_role", F.md5("answer").alias("digest"))
