"""Prompts, batch inference with a stand-in backend, and structured replies."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from corpusloom.functions import model_sql
from corpusloom.operators import inference, prompts, relational as rel, requests, structured
from corpusloom.plans.parallelism import spread
from corpusloom.plans.workspace import fresh_path, materialize
from corpusloom.suite import Suite, table, textual

suite = Suite()

INSTRUCTION = "Rate how formal this document is, from 0 (chat) to 2 (official), as one digit. Document: "
REPLY_DDL = "sentiment STRING, length BIGINT"
SENTIMENTS = {"sentiment": ["0", "1", "2"]}


def length_backend(texts: list[str]) -> list[str]:
    """Stand-in model: class and length by the size of the prompt, now and then malformed."""
    out = []
    for text in texts:
        n = len(text)
        if n % 7 == 0:
            out.append("I would say neutral")
        elif n % 7 == 1:
            out.append('{"sentiment":"1"}')
        elif n % 7 == 2:
            out.append(f'{{"sentiment":"0","length":"{n} characters"}}')
        else:
            out.append(f'{{"sentiment":"{n % 4}","length":{n}}}')
    return out


def _prompted(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text", "n_chars"))
    return docs.withColumn("prompt", prompts.instruct(INSTRUCTION, F.col("text")))


_REPLIES = f"""
p AS (SELECT doc_id, length('{INSTRUCTION}' || text) AS n FROM documents),
r AS (SELECT doc_id, n, CASE WHEN n % 7 = 0 THEN 'not a JSON object'
        WHEN n % 7 = 1 THEN 'missing length'
        WHEN n % 7 = 2 THEN 'wrong type of length'
        WHEN n % 4 = 3 THEN 'sentiment outside its values' ELSE '' END AS reasons FROM p)
"""


@suite.add(f"WITH {_REPLIES} SELECT doc_id, reasons, reasons = '' AS valid FROM r")
def checked_replies(spark, sf):
    answered = inference.infer(
        _prompted(spark, sf),
        "prompt",
        length_backend,
        response_ddl=REPLY_DDL,
        enums=SENTIMENTS,
        required=["sentiment", "length"],
    )
    return answered.select("doc_id", F.array_join("reasons", "|").alias("reasons"), "valid")


@suite.add(f"""
WITH {_REPLIES}
SELECT doc_id, CAST(CASE n % 7 WHEN 0 THEN NULL WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE n % 4 END AS BIGINT) AS sentiment,
       CAST(CASE WHEN n % 7 < 3 THEN NULL ELSE n END AS BIGINT) AS length
FROM r
""")
def reply_numbers(spark, sf):
    """Numbers read out of the replies by path; not-a-number becomes null, not an error."""
    answered = inference.infer(_prompted(spark, sf), "prompt", length_backend)
    return answered.select(
        "doc_id",
        structured.json_number(F.col("reply"), "$.sentiment").alias("sentiment"),
        structured.json_number(F.col("reply"), "$.length").alias("length"),
    )


@suite.add(f"""
WITH {_REPLIES} SELECT count(*) FILTER (reasons = '') AS accepted, count(*) FILTER (reasons <> '') AS rejected FROM r
""")
def accepted_and_rejected(spark, sf):
    answered = inference.infer(
        _prompted(spark, sf),
        "prompt",
        length_backend,
        response_ddl=REPLY_DDL,
        enums=SENTIMENTS,
        required=["sentiment", "length"],
    )
    accepted, rejected = structured.split_valid(materialize(answered.select("doc_id", "valid"), "answers"))
    parts = accepted.select(F.lit(1).alias("a"), F.lit(0).alias("r")).unionByName(
        rejected.select(F.lit(0).alias("a"), F.lit(1).alias("r"))
    )
    return parts.agg(F.sum("a").alias("accepted"), F.sum("r").alias("rejected"))


@suite.add(f"""
WITH {_REPLIES} SELECT doc_id, CASE WHEN reasons = '' THEN 'first' ELSE 'second' END AS asked FROM r
""")
def retried_replies(spark, sf):
    """Rejected replies are asked for once more, of a model that always answers well; both rounds share a store."""
    options = {"response_ddl": REPLY_DDL, "enums": SENTIMENTS, "required": ["sentiment", "length"]}
    store = fresh_path(spark, "replies")
    first = inference.infer(_prompted(spark, sf), "prompt", length_backend, store=store, model="length-1", **options)
    retried = inference.retry_rejected(first, "prompt", patient_backend, "reply", store=store, model="length-1", **options)
    second = F.col("parsed.length") < 0
    return retried.filter("valid").select("doc_id", F.when(second, "second").otherwise("first").alias("asked"))


def patient_backend(texts: list[str]) -> list[str]:
    """Stand-in model whose replies are valid and told apart by a negative length."""
    return [f'{{"sentiment":"0","length":{-len(t)}}}' for t in texts]


@suite.add(f"SELECT doc_id, md5('{INSTRUCTION}' || text) AS digest FROM documents")
def instruction_prompts(spark, sf):
    return _prompted(spark, sf).select("doc_id", F.md5("prompt").alias("digest"))


@suite.add("""
SELECT doc_id, md5('Text ' || doc_id || ' in ' || lang || ':' || chr(10) || text) AS digest FROM documents
""")
def template_prompts(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "lang", "text"))
    prompt = prompts.render_prompt("Text {doc_id} in {lang}:\n{text}", "doc_id", "lang", "text")
    return docs.select("doc_id", F.md5(prompt).alias("digest"))


@suite.add("""
WITH s AS (SELECT 'Name the region of a nation.' || chr(10) ||
             string_agg(n_name || ' is in ' || r_name, chr(10) ORDER BY n_nationkey) || chr(10) || 'Take your time.' || chr(10) AS shots
           FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey, md5(shots || n_name) AS digest FROM customer JOIN nation ON c_nationkey = n_nationkey, s
""")
def few_shot_prompts(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    examples = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("pos"), F.concat("n_name", F.lit(" is in "), "r_name").alias("example")
    )
    shots = prompts.few_shot_prompt("Name the region of a nation.", examples, "Take your time.\n")
    customer = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return customer.select("c_custkey", F.md5(F.concat(shots, F.col("n_name"))).alias("digest"))


def _longer_than(n: int):
    def backend(texts: list[str]) -> list[str]:
        return ["1" if len(t) >= n else "0" for t in texts]

    return backend


def _compared(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    docs = spread(table(spark, sf, "documents").select("doc_id", "text")).join(labels, "doc_id")
    return inference.compare_models(docs, "text", {"long": _longer_than(500), "short": _longer_than(200)}, "quality")


_COMPARED = """
r AS (SELECT m.model, CAST(quality AS VARCHAR) AS t, CASE WHEN length(text) >= m.n THEN '1' ELSE '0' END AS p
      FROM documents JOIN labels USING (doc_id), (VALUES ('long', 500), ('short', 200)) m(model, n))
"""


@suite.add(f"""
WITH {_COMPARED},
c AS (SELECT model, t AS class FROM r UNION SELECT model, p FROM r)
SELECT c.model, class,
       CAST((SELECT count(*) FROM r WHERE r.model = c.model AND t = class) AS BIGINT) AS support,
       round((SELECT count(*) FILTER (t = p) / nullif(count(*), 0) FROM r WHERE r.model = c.model AND p = class), 6) AS precision,
       round((SELECT count(*) FILTER (t = p) / nullif(count(*), 0) FROM r WHERE r.model = c.model AND t = class), 6) AS recall,
       round((SELECT avg(CAST(t = p AS INT)) FROM r WHERE r.model = c.model), 6) AS accuracy
FROM c
""")
def model_scores(spark, sf):
    report = rel.classification_report(_compared(spark, sf), "truth", "pred", ["model"])
    return report.select(
        "model", "class", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "accuracy")]
    )


@suite.add(f"""
WITH {_COMPARED} SELECT model, count(*) AS replies, round(avg(CAST(p IN ('1') AS INT)), 6) AS compliance FROM r GROUP BY model
""")
def model_compliance(spark, sf):
    rate = rel.compliance_rate(_compared(spark, sf), "pred", ["1"], ["model"])
    return rate.withColumn("compliance", F.round("compliance", 6))


@suite.add("SELECT c_custkey, upper('Write a reply to ' || c_name || ' of ' || c_mktsegment) AS answer FROM customer")
def generated_answers(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    answered = inference.generate(
        customer, "Write a reply to {c_name} of {c_mktsegment}", lambda texts: [t.upper() for t in texts]
    )
    return answered.select("c_custkey", "answer")


@suite.add("""
SELECT c_custkey, 0 AS line_no, true AS valid, c_name AS first_name, c_custkey AS n FROM customer
UNION ALL SELECT c_custkey, 1, false, NULL, NULL FROM customer
UNION ALL SELECT c_custkey, 2, true, c_mktsegment, NULL FROM customer
""")
def jsonl_rows(spark, sf):
    """A reply of three lines per customer, the second without a value; fences and commas are removed."""
    reply = F.format_string(
        '```jsonl\n{"first_name": "%s", "n": %d},\n\n{"first_name": "%s", "no value"},\n{"first_name": "%s"}\n```',
        "c_name",
        "c_custkey",
        "c_name",
        "c_mktsegment",
    )
    replies = table(spark, sf, "customer").select("c_custkey", reply.alias("reply"))
    rows = structured.parse_jsonl(replies, "reply", "first_name STRING, n BIGINT", ["c_custkey"])
    return rows.select("c_custkey", "line_no", "valid", "parsed.first_name", "parsed.n")


@suite.add("""
SELECT p_partkey, array_to_string(list_distinct_in_order, '|') AS tags FROM (
  SELECT p_partkey, [p_brand] || list_filter(list_transform(string_split(p_type, ' '), lambda x: trim(x)),
         lambda x, i: x <> '' AND x <> p_brand
                      AND list_position(list_transform(string_split(p_type, ' '), lambda y: trim(y)), x) = i) AS list_distinct_in_order
  FROM part)
""")
def multi_values(spark, sf):
    delimited = F.concat(F.col("p_brand"), F.lit(" , "), F.replace(F.col("p_type"), F.lit(" "), F.lit(",")), F.lit(",,"), F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(structured.split_multi(delimited), "|").alias("tags"))


def sql_backend(texts: list[str], response_format: str | None) -> list[str]:
    """Stand-in model for SQL: a JSON rating when a schema is asked for, else a digit or an excuse."""
    if response_format:
        return [f'{{"formality":{len(t) % 3},"doubt":{"true" if len(t) % 5 == 0 else "false"}}}' for t in texts]
    return [str(len(t) % 3) if len(t) % 5 else "hard to say" for t in texts]


# The envelope of a response schema is an interface of ai_query; what it asks for is this query's own.
RESPONSE_FORMAT = json.dumps(
    {
        "type": "json_schema",
        "json_schema": {
            "name": "rating",
            "schema": {"type": "object", "properties": {"formality": {"type": "integer"}, "doubt": {"type": "boolean"}}},
        },
    }
)


@suite.add(f"""
WITH p AS (SELECT doc_id, lang, length('{INSTRUCTION}' || text) AS n FROM documents)
SELECT lang, count(*) AS ratings, CAST(sum(n % 3) AS BIGINT) AS total, count_if(n % 5 = 0) AS doubtful,
       count_if(n % 5 = 0) AS without_digit
FROM p GROUP BY lang
""")
def sql_inference(spark, sf):
    """Ratings by language, asked for in SQL with and without a response schema and read in the same select list."""
    model_sql.register_model_functions(spark, {"rater": sql_backend})
    spread(table(spark, sf, "documents").select("lang", "text")).createOrReplaceTempView("documents_t")
    return spark.sql(
        f"""
        SELECT lang, count(*) AS ratings, sum(formality) AS total, count_if(doubt) AS doubtful,
               count_if(digit IS NULL) AS without_digit
        FROM (
          SELECT lang, concat('{INSTRUCTION}', text) AS request,
                 try_cast(ai_query('rater', request) AS INT) AS digit,
                 from_json(ai_query('rater', request, responseFormat => '{RESPONSE_FORMAT}'),
                           'formality BIGINT, doubt BOOLEAN') AS rating,
                 rating.formality AS formality, rating.doubt AS doubt
          FROM documents_t)
        GROUP BY lang
        """
    )


@suite.add(f"""
WITH p AS (SELECT o_orderkey, length('{INSTRUCTION}' || o_orderpriority || ' ' || o_orderstatus) AS n,
                  length('{INSTRUCTION}' || o_orderstatus) AS m FROM orders)
SELECT o_orderkey, CASE WHEN n % 5 <> 0 THEN CAST(n % 3 AS INT) END AS digit, CAST(m % 3 AS BIGINT) AS formality, m % 5 = 0 AS doubt
FROM p
""")
def sql_requests(spark, sf):
    """Every order rated twice by requests in SQL; the orders share a few prompts, each of which is asked once."""
    requests.register_requests(spark)
    spread(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")).createOrReplaceTempView("orders_r")
    asked = spark.sql(
        f"""
        SELECT o_orderkey, ai_request('rater', concat('{INSTRUCTION}', o_orderpriority, ' ', o_orderstatus)) AS digit,
               ai_request('rater', concat('{INSTRUCTION}', o_orderstatus), responseFormat => '{RESPONSE_FORMAT}') AS rating
        FROM orders_r
        """
    )
    rated = requests.answer_requests(asked, {"rater": sql_backend})
    rating = F.from_json("rating", "formality BIGINT, doubt BOOLEAN")
    return rated.select("o_orderkey", F.col("digit").try_cast("int").alias("digit"), rating.alias("r")).select("o_orderkey", "digit", "r.*")


@suite.add(r"""
SELECT conv_id, turn, md5(regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[MASKED]', 'g'),
         '\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b', '[MASKED]', 'g')) AS masked,
  CASE sign(list_sum([0] || list_transform(w, lambda x: CASE x WHEN 'the' THEN 1 WHEN 'le' THEN 1 WHEN 'und' THEN -2 WHEN 'of' THEN -1 ELSE 0 END)))
    WHEN 1 THEN 'positive' WHEN -1 THEN 'negative' ELSE 'neutral' END AS sentiment,
  CASE WHEN en >= greatest(fr, de, 1) THEN 'the and' WHEN fr >= greatest(de, 1) THEN 'le la' WHEN de > 0 THEN 'der und' END AS language
FROM (SELECT *, len(list_filter(w, lambda x: x IN ('the', 'and'))) AS en, len(list_filter(w, lambda x: x IN ('le', 'la'))) AS fr,
             len(list_filter(w, lambda x: x IN ('der', 'und'))) AS de
      FROM (SELECT *, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM conversations))
""")
def sql_text_functions(spark, sf):
    """The text functions in SQL over all conversation turns."""
    model_sql.register_model_functions(spark, lexicon={"the": 1, "le": 1, "und": -2, "of": -1})
    table(spark, sf, "conversations").createOrReplaceTempView("conversations_t")
    return spark.sql(
        """
        SELECT conv_id, turn, md5(ai_mask(text, array('email', 'ip_address'))) AS masked,
               ai_analyze_sentiment(text) AS sentiment,
               ai_classify(text, array('the and', 'le la', 'der und')) AS language
        FROM conversations_t
        """
    )


# Tokens that every document is compared with.
_COMMON = "the and of is"
_TOKENS = r"list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]'))"


@suite.add(rf"""
WITH {textual.SUMMARY_SQL},
c AS (SELECT k.*, sum(len(regexp_extract_all(lower(sentence), '{textual.WORD_SQL}'))) OVER (PARTITION BY doc_id ORDER BY n) AS held
      FROM k JOIN u USING (doc_id, pos)),
y AS (SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS summary FROM c JOIN u USING (doc_id, pos) WHERE n = 1 OR held <= 20 GROUP BY 1),
g AS (SELECT doc_id, digest AS fixed FROM ({textual.suite.oracles["grammar_rules"]})),
t AS (SELECT doc_id, digest AS translated FROM ({textual.suite.oracles["glossary_translation"]})),
e AS (SELECT doc_id, email AS emails FROM ({textual.suite.oracles["extracted_entities"]})),
l AS (SELECT doc_id, {_TOKENS} AS own, string_split('{_COMMON}', ' ') AS common FROM documents)
SELECT d.doc_id, md5(coalesce(summary, '')) AS summary, fixed, translated, emails,
       round(len(list_intersect(own, common)) / (len(own) + len(common) - len(list_intersect(own, common))), 6) AS likeness,
       CASE WHEN length(text) % 5 = 0 THEN 'hard to say' ELSE CAST(length(text) % 3 AS VARCHAR) END AS generated
FROM documents d JOIN g USING (doc_id) JOIN t USING (doc_id) JOIN e USING (doc_id) JOIN l USING (doc_id) LEFT JOIN y USING (doc_id)
""")
def sql_more_functions(spark, sf):
    """Summaries, grammar, translation, extraction, likeness and free generation in SQL over all documents."""
    model_sql.register_model_functions(spark, {"rater": sql_backend}, "rater", glossaries={"es": dict(textual.GLOSSARY)})
    spread(table(spark, sf, "documents").select("doc_id", "text")).createOrReplaceTempView("documents_m")
    return spark.sql(
        f"""
        SELECT doc_id, md5(ai_summarize(text, 20)) AS summary, md5(ai_fix_grammar(text)) AS fixed, md5(ai_translate(text, 'es')) AS translated,
               array_join(ai_extract(text, array('email'))['email'], '|') AS emails,
               round(ai_similarity(text, '{_COMMON}'), 6) AS likeness, ai_gen(text) AS generated
        FROM documents_m
        """
    )
