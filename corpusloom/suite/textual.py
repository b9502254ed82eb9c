"""Deterministic baselines of the model-backed text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import baselines, evaluation
from corpusloom.plans.parallelism import spread
from corpusloom.suite import Suite, table

suite = Suite()

WORD_SQL = r"[\p{L}\p{N}]+"

# Small word lists made of words frequent in the test texts.
LEXICON = [("the", 1), ("and", -1), ("of", -1), ("is", 1), ("der", 2), ("und", -2), ("le", 1), ("et", -1), ("el", 1), ("que", -2)]
KEYWORDS = [("en", "the"), ("en", "and"), ("de", "und"), ("de", "der"), ("fr", "le"), ("fr", "et"), ("es", "el"), ("es", "que")]
GLOSSARY = [("the", "el"), ("and", "y"), ("of", "de"), ("is", "es"), ("with", "con"), ("in", "en"), ("for", "para"), ("by", "por"), ("that", "que"), ("it", "lo")]


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)


def _docs(spark, sf, *columns):
    return spread(table(spark, sf, "documents").select(*columns))


@suite.add(f"""
WITH l(word, weight) AS (VALUES {_values(LEXICON)}),
s AS (SELECT doc_id, coalesce(sum(weight), 0) AS score FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [NULL] ELSE w END) AS word
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '{WORD_SQL}') AS w FROM documents))
      LEFT JOIN l USING (word) GROUP BY doc_id)
SELECT doc_id, CAST(score AS BIGINT) AS score,
       CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END AS sentiment FROM s
""")
def lexicon_sentiment(spark, sf):
    lexicon = spark.createDataFrame(LEXICON, "word string, weight int")
    return baselines.sentiment(_docs(spark, sf, "doc_id", "text"), ["doc_id"], "text", lexicon)


@suite.add(f"""
WITH k(label, word) AS (VALUES {_values(KEYWORDS)}),
h AS (SELECT doc_id, label, count(label) AS hits FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [NULL] ELSE w END) AS word
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '{WORD_SQL}') AS w FROM documents))
      LEFT JOIN k USING (word) GROUP BY doc_id, label)
SELECT doc_id, label, hits FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, label NULLS LAST) AS r FROM h) WHERE r = 1
""")
def keyword_classes(spark, sf):
    keywords = spark.createDataFrame(KEYWORDS, "label string, word string")
    return baselines.classify(_docs(spark, sf, "doc_id", "text"), ["doc_id"], "text", keywords)


_FOUND = ("email", "ip_address", "phone")


def _distinct_in_order(pattern: str) -> str:
    """Distinct matches in order of appearance."""
    found = f"regexp_extract_all(text, '{pattern}')"
    return f"array_to_string(list_filter({found}, lambda x, i: list_position({found}, x) = i), '|')"


@suite.add(
    "SELECT doc_id, "
    + ", ".join(f"{_distinct_in_order(baselines.PATTERNS[label])} AS {label}" for label in _FOUND)
    + " FROM documents"
)
def extracted_entities(spark, sf):
    patterns = {label: baselines.PATTERNS[label] for label in _FOUND}
    found = baselines.extract(_docs(spark, sf, "doc_id", "text"), "text", patterns)
    return found.select("doc_id", *[F.array_join(f"entities.{label}", "|").alias(label) for label in patterns])


def _masked_sql() -> str:
    text = "text"
    for label in _FOUND:
        text = f"regexp_replace({text}, '{baselines.PATTERNS[label]}', '[MASKED]', 'g')"
    return text


@suite.add(f"SELECT doc_id, md5({_masked_sql()}) AS digest FROM documents")
def masked_entities(spark, sf):
    masked = baselines.mask_entities(F.col("text"), _FOUND)
    return _docs(spark, sf, "doc_id", "text").select("doc_id", F.md5(masked).alias("digest"))


@suite.add(r"""
WITH a AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), ' ([,.;:!?])', '\1', 'g'), ' ') AS w
           FROM documents),
b AS (SELECT doc_id, array_to_string(list_filter(w, lambda x, i: i = 1 OR x = '' OR lower(x) <> lower(w[i - 1])), ' ') AS t FROM a),
c AS (SELECT doc_id, regexp_extract_all(t, '\s*[^.!?\s][^.!?]*[.!?]*|\s+|[.!?]+') AS p FROM b)
SELECT doc_id, md5(array_to_string(list_transform(p, lambda s:
         substr(s, 1, length(regexp_extract(s, '^\s*'))) ||
         upper(substr(s, length(regexp_extract(s, '^\s*')) + 1, 1)) ||
         substr(s, length(regexp_extract(s, '^\s*')) + 2)), '')) AS digest
FROM c
""")
def grammar_rules(spark, sf):
    fixed = baselines.fix_grammar(F.col("text"))
    return _docs(spark, sf, "doc_id", "text").select("doc_id", F.md5(fixed).alias("digest"))


@suite.add(r"""
WITH t AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) AS tok FROM conversations),
n AS (SELECT conv_id, turn, tok, count(*) AS n FROM t GROUP BY ALL),
l AS (SELECT conv_id, turn, count(*) AS d, sqrt(sum(n * n)) AS len FROM n GROUP BY ALL),
x AS (SELECT a.conv_id, a.turn, count(*) AS shared, sum(a.n * b.n) AS dot
      FROM n a JOIN n b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND a.tok = b.tok GROUP BY ALL)
SELECT c.conv_id, c.turn,
       round(coalesce(shared / (la.d + lb.d - shared), 0), 6) AS jaccard,
       round(coalesce(dot / (la.len * lb.len), 0), 6) AS cosine
FROM conversations c JOIN conversations f ON c.conv_id = f.conv_id AND f.turn = c.turn + 1
LEFT JOIN l la ON la.conv_id = c.conv_id AND la.turn = c.turn
LEFT JOIN l lb ON lb.conv_id = c.conv_id AND lb.turn = c.turn + 1
LEFT JOIN x ON x.conv_id = c.conv_id AND x.turn = c.turn
""")
def turn_similarity(spark, sf):
    """Likeness of each turn and the next one."""
    turns = spread(table(spark, sf, "conversations"))
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next_text"))
    pairs = turns.join(following, ["conv_id", "turn"])
    scored = pairs.withColumn("s", baselines.similarity(F.col("text"), F.col("next_text")))
    return scored.select(
        "conv_id", "turn", F.round("s.jaccard", 6).alias("jaccard"), F.round("s.cosine", 6).alias("cosine")
    )


SUMMARY_SQL = rf"""
s AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?\n]+[.!?]*|[.!?]+'),
             lambda x: trim(x, chr(32) || chr(9) || chr(13) || chr(10))), lambda x: x <> '') AS ss FROM documents),
u AS (SELECT doc_id, unnest(ss) AS sentence, unnest(range(len(ss))) AS pos FROM s),
w AS (SELECT doc_id, pos, unnest(regexp_extract_all(lower(sentence), '{WORD_SQL}')) AS word FROM u),
f AS (SELECT doc_id, word, count(*) AS tf FROM w GROUP BY ALL),
r AS (SELECT doc_id, pos, round(avg(tf), 6) AS score FROM w JOIN f USING (doc_id, word) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS n FROM r)
"""


@suite.add(f"""WITH {SUMMARY_SQL}
SELECT doc_id, md5(coalesce(any_value(summary), '')) AS digest FROM documents LEFT JOIN (
  SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS summary FROM k JOIN u USING (doc_id, pos) WHERE n <= 2 GROUP BY doc_id)
USING (doc_id) GROUP BY doc_id
""")
def summaries(spark, sf):
    summary = baselines.summarize(F.col("text"), 2)
    # Texts without a word have an empty summary.
    return _docs(spark, sf, "doc_id", "text").select("doc_id", F.md5(summary).alias("digest"))


@suite.add(rf"""
WITH g(source, target) AS (VALUES {_values(GLOSSARY)}),
m AS (SELECT map_from_entries(list((source, target))) AS m FROM g)
SELECT doc_id, md5(array_to_string(list_transform(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'),
         lambda p: coalesce(m[lower(p)], p)), '')) AS digest
FROM documents, m
""")
def glossary_translation(spark, sf):
    glossary = spark.createDataFrame(GLOSSARY, "source string, target string")
    translated = baselines.translate(_docs(spark, sf, "doc_id", "text"), ["doc_id"], "text", glossary)
    return translated.select("doc_id", F.md5("translation").alias("digest"))


# Longest alternatives come first. What stands between words is put between two marks, so that words have borders in any script.
@suite.add(r"""
WITH p AS (SELECT DISTINCT lower(regexp_extract(text, '^([A-Za-z]+ [A-Za-z]+)')) AS phrase FROM benchmark
           UNION SELECT DISTINCT lower(regexp_extract(text, '^([A-Za-z]+ [A-Za-z]+ [A-Za-z]+)')) FROM benchmark),
a AS (SELECT '(?i)(^|\x01)(?:' || string_agg(replace(phrase, ' ', '\x02\s+\x01'), '|' ORDER BY length(phrase) DESC, phrase) || ')(\x02|$)' AS pattern
      FROM p WHERE phrase <> ''),
m AS (SELECT doc_id, text, regexp_replace(regexp_replace(text, '([^\p{L}\p{N}]+)', chr(2) || '\1' || chr(1), 'g'), pattern, '\1[MASKED]\2', 'g') AS marked
      FROM documents, a WHERE lang = 'en'),
r AS (SELECT doc_id, text, replace(replace(marked, chr(1), ''), chr(2), '') AS masked FROM m)
SELECT doc_id, md5(masked) AS digest, text <> masked AS changed FROM r
""")
def masked_phrases(spark, sf):
    """Phrases of two and three words, from the beginnings of the benchmark's passages, masked in English documents."""
    start = F.col("text")
    phrases = [F.regexp_extract(start, rf"^[A-Za-z]+(?: [A-Za-z]+){{{n}}}", 0) for n in (1, 2)]
    terms = table(spark, sf, "benchmark").select(F.explode(F.array(*phrases)).alias("term"))
    docs = spread(table(spark, sf, "documents").filter("lang = 'en'").select("doc_id", "text"))
    masked = baselines.mask_terms(docs, ["doc_id"], "text", terms).withColumnRenamed("doc_id", "id")
    joined = docs.join(masked, F.col("doc_id") == F.col("id"))
    return joined.select("doc_id", F.md5("translation").alias("digest"), (F.col("text") != F.col("translation")).alias("changed"))


@suite.add("""
SELECT doc_id, round(206.835::DOUBLE - 1.015::DOUBLE * (w::DOUBLE / greatest(s, 1)::DOUBLE)
                     - 84.6::DOUBLE * (y::DOUBLE / nullif(w, 0)::DOUBLE), 4) AS ease FROM (
  SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]+')) AS w, len(regexp_extract_all(text, '[.!?]+')) AS s,
         len(regexp_extract_all(lower(text), '[aeiouy]+')) AS y
  FROM documents)
""")
def readability(spark, sf):
    docs = _docs(spark, sf, "doc_id", "text")
    return docs.select("doc_id", F.round(evaluation.reading_ease(F.col("text")), 4).alias("ease"))
