"""Evaluation sets and measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import evaluation
from corpusloom.plans.parallelism import spread
from corpusloom.suite import Suite, table
from corpusloom.suite.textual import SUMMARY_SQL

suite = Suite()

QUESTION = "What does {doc_uri} say about: {topic}?"


@suite.add(f"""WITH {SUMMARY_SQL},
d AS (SELECT md5('7:' || source || '/' || doc_id || '|' || text) AS request_id, source || '/' || doc_id AS uri, doc_id, text
      FROM documents ORDER BY request_id, uri LIMIT 5)
SELECT request_id, uri AS source, md5(text) AS context,
       'What does ' || uri || ' say about: ' || coalesce(sentence, '') || '?' AS question
FROM d LEFT JOIN k ON k.doc_id = d.doc_id AND n = 1 LEFT JOIN u ON u.doc_id = k.doc_id AND u.pos = k.pos
""")
def evaluation_set(spark, sf):
    """Five questions on the documents, the first five in hash order."""
    uri = F.concat_ws("/", "source", "doc_id")
    docs = spread(table(spark, sf, "documents")).select(uri.alias("doc_uri"), F.col("text").alias("content"))
    picked = evaluation.build_eval_set(docs, 5, QUESTION, seed=7)
    return picked.select("request_id", "source", F.md5("expected_context").alias("context"), "question")


def _runs(spark, sf):
    """Each turn with its next turn as the answer, the last text of its conversation as the truth,
    and the document of the same number as the context."""
    turns = spread(table(spark, sf, "conversations"))
    answers = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    last = turns.groupBy("conv_id").agg(F.max_by("text", "turn").alias("expected_response"), F.max("turn").alias("last"))
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("conv_id"), F.col("text").alias("context"), "lang")
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("conv_id"), "toxic")
    return (
        turns.withColumnRenamed("text", "question")
        .join(answers, ["conv_id", "turn"])
        .join(last, "conv_id")
        .join(docs, "conv_id", "left")
        .join(labels, "conv_id", "left")
        .withColumn("retrieved_ids", F.array("conv_id", "turn"))
        .withColumn("expected_ids", F.array("conv_id", "last"))
    )


_RUNS = r"""
w AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS ws FROM conversations),
z AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY conv_id),
r AS (
  SELECT q.conv_id, q.turn, q.ws AS q, a.ws AS a, t.ws AS t, last, lang, toxic,
         list_distinct(regexp_extract_all(lower(coalesce(d.text, '')), '[\p{L}\p{N}]+')) AS c
  FROM w q JOIN w a ON q.conv_id = a.conv_id AND a.turn = q.turn + 1 JOIN z ON z.conv_id = q.conv_id
  JOIN w t ON t.conv_id = q.conv_id AND t.turn = last
  LEFT JOIN documents d ON d.doc_id = q.conv_id LEFT JOIN labels l ON l.doc_id = q.conv_id),
m AS (
  SELECT conv_id, turn, lang,
    coalesce(2 * len(list_intersect(a, t)) / nullif(len(a) + len(t), 0), 0) AS correctness,
    coalesce(len(list_intersect(a, c)) / nullif(len(a), 0), 0) AS groundedness,
    coalesce(len(list_intersect(q, a)) / nullif(len(q), 0), 0) AS relevance,
    len(list_intersect([conv_id, turn], [conv_id, last])) / len(list_distinct([conv_id, turn])) AS retrieval_precision,
    len(list_intersect([conv_id, turn], [conv_id, last])) / len(list_distinct([conv_id, last])) AS retrieval_recall,
    CAST(toxic AS DOUBLE) AS toxicity
  FROM r)
"""


@suite.add(
    f"WITH {_RUNS} SELECT conv_id, turn, "
    + ", ".join(f"round({m}, 6) AS {m}" for m in evaluation.MEASURES)
    + " FROM m"
)
def measured_answers(spark, sf):
    measured = evaluation.evaluate(_runs(spark, sf))
    return measured.select("conv_id", "turn", *[F.round(m, 6).alias(m) for m in evaluation.MEASURES])


@suite.add(
    f"WITH {_RUNS} SELECT lang, count(*) AS rows, "
    + ", ".join(f"round(avg({m}), 6) AS {m}" for m in evaluation.MEASURES)
    + " FROM m GROUP BY lang"
)
def run_summary(spark, sf):
    summary = evaluation.summarize_run(evaluation.evaluate(_runs(spark, sf)), by=["lang"])
    return summary.select("lang", "rows", *[F.round(m, 6).alias(m) for m in evaluation.MEASURES])


@suite.add("""
SELECT lang, count(*) AS rows, round(avg(CAST(toxic AS DOUBLE)), 6) AS toxicity
FROM documents JOIN labels USING (doc_id) GROUP BY lang
""")
def toxic_share(spark, sf):
    labelled = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id")
    summary = evaluation.summarize_run(evaluation.evaluate(labelled, ["toxicity"]), by=["lang"])
    return summary.withColumn("toxicity", F.round("toxicity", 6))
