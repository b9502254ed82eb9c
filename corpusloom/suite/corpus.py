"""Text extraction, chunking and embedding."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import chunking, embedding
from corpusloom.operators.relational import append_chunks
from corpusloom.plans.corpus import chunk_table
from corpusloom.plans.parallelism import spread
from corpusloom.sources.tables import with_chunk_id
from corpusloom.suite import Suite, table

suite = Suite()

# Token rules in the oracle's dialect, written from their definition.
TOKEN_SQL = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
SPACED_SQL = r"\s*(?:[\p{L}\p{N}]+|[^\s\p{L}\p{N}])"


def trim_sql(expr: str) -> str:
    return f"trim({expr}, chr(32) || chr(9) || chr(13) || chr(10))"


ARTICLE_SQL = r"""
regexp_replace(regexp_replace(
  regexp_extract(html, '(?is)<article\b[^>]*>(.*?)</article>', 1),
  '(?is)<script\b.*?</script>', '', 'g'), '(?is)<style\b.*?</style>', '', 'g')
"""


def page_text_sql() -> str:
    text = ARTICLE_SQL
    for level in range(1, 7):
        text = f"regexp_replace({text}, '(?i)<h{level}\\b[^>]*>', chr(10) || '{'#' * level} ', 'g')"
    text = f"regexp_replace({text}, '(?i)</h[1-6]>', chr(10), 'g')"
    text = f"regexp_replace({text}, '(?i)<li\\b[^>]*>', chr(10) || '- ', 'g')"
    text = f"regexp_replace({text}, '(?i)<br\\b[^>]*>', chr(10), 'g')"
    text = f"regexp_replace({text}, '(?i)</p>', chr(10) || chr(10), 'g')"
    text = f"regexp_replace({text}, '<[^>]*>', '', 'g')"
    text = f"regexp_replace({text}, '\\n[ \\t\\r]*\\n[ \\t\\r\\n]*\\n', chr(10) || chr(10), 'g')"
    for entity, char in [("lt", "<"), ("gt", ">"), ("quot", '"'), ("#34", '"'), ("#39", "''"), ("#x27", "''"),
                         ("apos", "''"), ("nbsp", " "), ("#160", " "), ("amp", "&")]:
        text = f"replace({text}, '&{entity};', '{char}')"
    return trim_sql(text)


PAGE_TEXT_SQL = (
    f"SELECT page_id, url, {page_text_sql()} AS text FROM pages WHERE regexp_matches(html, '(?is)<article\\b[^>]*>.*?</article>')"
)


def windows_sql(source: str, ids: str, text: str = "text", size: int = 500, overlap: int = 50, least: int = 20) -> str:
    """Plain windows of a relation ``source``: ids, pos, content, n_tokens."""
    return f"""
SELECT {ids}, pos, content, n_tokens FROM (
  SELECT {ids}, CAST(start // {size - overlap} AS INT) AS pos, content,
         CAST(len(regexp_extract_all(content, '{TOKEN_SQL}')) AS INT) AS n_tokens
  FROM (SELECT {ids}, start, {trim_sql(f"array_to_string(list_slice(toks, start + 1, start + {size}), '')")} AS content
        FROM (SELECT {ids}, toks, unnest(range(0, greatest(len(toks) - {overlap + 1}, 0) + 1, {size - overlap})) AS start
              FROM (SELECT {ids}, regexp_extract_all({text}, '{SPACED_SQL}') AS toks FROM ({source}))
              WHERE len(toks) > 0)))
WHERE n_tokens > {least}
"""


@suite.add(f"SELECT page_id, CAST(length(text) AS INT) AS n_chars, md5(text) AS digest FROM ({PAGE_TEXT_SQL})")
def page_texts(spark, sf):
    pages = chunking.extract_pages(spread(table(spark, sf, "pages")))
    return pages.select("page_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


@suite.add(
    f"""SELECT md5(concat_ws('|', url, pos, content)) AS id, url, md5(content) AS digest
FROM ({windows_sql(f"SELECT url, text FROM ({PAGE_TEXT_SQL})", "url")})"""
)
def page_chunks(spark, sf):
    """Pages to keyed chunks: extract, section, window, filter, key."""
    chunks = chunk_table(spread(table(spark, sf, "pages")), boundaries=False)
    return chunks.select("id", "url", F.md5("content").alias("digest"))


@suite.add(f"SELECT doc_id, CAST(len(regexp_extract_all(text, '{TOKEN_SQL}')) AS INT) AS n_tokens FROM documents")
def token_counts(spark, sf):
    return spread(table(spark, sf, "documents")).select("doc_id", tx.token_count(F.col("text")).alias("n_tokens"))


@suite.add(
    f"SELECT doc_id, pos, n_tokens, md5(content) AS digest FROM ({windows_sql('SELECT doc_id, text FROM documents', 'doc_id')})"
)
def document_windows(spark, sf):
    chunks = chunking.chunk_windows(spread(table(spark, sf, "documents")), "text", ["doc_id"])
    return chunks.select("doc_id", "pos", "n_tokens", F.md5("content").alias("digest"))


@suite.add(f"""
WITH c AS ({windows_sql('SELECT doc_id, lang, text FROM documents', 'doc_id, lang')})
SELECT lang, count(*) AS chunks, CAST(sum(n_tokens) AS BIGINT) AS n_tokens,
       CAST(sum(CAST(('0x' || substr(md5(content), 1, 8)) AS BIGINT)) AS BIGINT) AS digest
FROM c GROUP BY lang
""")
def appended_chunks(spark, sf):
    """English and other documents chunked apart and appended, as two sources of one table."""
    docs = spread(table(spark, sf, "documents"))
    parts = [
        chunking.chunk_windows(docs.filter(which), "text", ["doc_id", "lang"])
        for which in (F.col("lang").eqNullSafe("en"), ~F.col("lang").eqNullSafe("en"))
    ]
    digest = F.conv(F.substr(F.md5("content"), F.lit(1), F.lit(8)), 16, 10).cast("long")
    return (
        append_chunks(*parts)
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("chunks"), F.sum("n_tokens").alias("n_tokens"), F.sum(digest).alias("digest"))
    )


@suite.add(f"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all({trim_sql('text')}, '{SPACED_SQL}') AS toks FROM documents),
w AS (
  SELECT doc_id, CAST(0 AS BIGINT) AS start, 0 AS pos, CAST(NULL AS BIGINT) AS stop FROM t WHERE len(toks) > 0
  UNION ALL
  SELECT doc_id, CASE WHEN e >= n THEN n ELSE e - 50 END, pos + 1, e
  FROM (SELECT w.doc_id, w.start, w.pos, len(toks) AS n,
          CASE WHEN w.start + 500 >= len(toks) THEN len(toks) ELSE coalesce(
            list_max([x FOR x IN range(w.start + 251, w.start + 501) IF regexp_matches(toks[x + 1], '\\n[ \\t\\r]*\\n')]),
            list_max([x FOR x IN range(w.start + 251, w.start + 501) IF regexp_matches(toks[x + 1], '\\n')]),
            list_max([x FOR x IN range(w.start + 251, w.start + 501) IF regexp_matches(toks[x + 1], '^\\s')]),
            w.start + 500) END AS e
        FROM w JOIN t USING (doc_id) WHERE w.start < len(toks))),
s AS (SELECT a.doc_id, a.pos, a.start, b.stop FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1),
c AS (SELECT doc_id, pos, {trim_sql("array_to_string(list_slice(toks, start + 1, stop), '')")} AS content FROM s JOIN t USING (doc_id))
SELECT doc_id, pos, CAST(len(regexp_extract_all(content, '{TOKEN_SQL}')) AS INT) AS n_tokens, md5(content) AS digest
FROM c WHERE len(regexp_extract_all(content, '{TOKEN_SQL}')) > 20
""")
def document_chunks(spark, sf):
    """The default chunker over all documents: windows that end at text boundaries."""
    chunks = chunking.chunk_documents(spread(table(spark, sf, "documents")), "text", ["doc_id"])
    return chunks.select("doc_id", "pos", "n_tokens", F.md5("content").alias("digest"))


@suite.add(f"""
WITH RECURSIVE d AS (
  SELECT doc_id, replace(text, '. ', '.' || chr(10) || '## Part' || chr(10)) AS text FROM documents),
p AS (
  SELECT doc_id, unnest(string_split(chr(10) || text, chr(10) || '## ')) AS piece,
         generate_subscripts(string_split(chr(10) || text, chr(10) || '## '), 1) AS i FROM d),
s AS (
  SELECT doc_id, i, CASE WHEN i = 1 THEN '' ELSE trim(string_split(piece, chr(10))[1]) END AS heading,
         {trim_sql("CASE WHEN i = 1 THEN piece ELSE substr(piece, length(string_split(piece, chr(10))[1]) + 2) END")} AS body FROM p),
k AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i, heading || chr(10) || body || chr(10) AS content,
         len(regexp_extract_all(heading || chr(10) || body, '{TOKEN_SQL}')) AS n FROM s WHERE body <> ''),
f AS (
  SELECT doc_id, i, content AS prev, n, CAST(NULL AS VARCHAR) AS done FROM k WHERE i = 1
  UNION ALL
  SELECT f.doc_id, f.i + 1,
         CASE WHEN k.doc_id IS NULL THEN NULL WHEN f.n + k.n <= 250 THEN f.prev || k.content ELSE k.content END,
         CASE WHEN f.n + k.n <= 250 THEN f.n + k.n ELSE k.n END,
         CASE WHEN k.doc_id IS NOT NULL AND f.n + k.n <= 250 THEN NULL ELSE {trim_sql('f.prev')} END
  FROM f LEFT JOIN k ON f.doc_id = k.doc_id AND k.i = f.i + 1 WHERE f.prev IS NOT NULL)
SELECT doc_id, CAST(coalesce(any_value(m.sections), 0) AS INT) AS sections, md5(coalesce(any_value(m.content), '')) AS digest
FROM documents LEFT JOIN (SELECT doc_id, count(done) AS sections, string_agg(done, '|' ORDER BY i) AS content FROM f GROUP BY doc_id) m
USING (doc_id) GROUP BY doc_id
""")
def merged_sections(spark, sf):
    """Documents with a heading before every sentence; small sections merged up to half the bound."""
    docs = spread(table(spark, sf, "documents"))
    headed = F.replace(F.col("text"), F.lit(". "), F.lit(".\n## Part\n"))
    merged = docs.select("doc_id", tx.merge_sections(headed).alias("s"))
    return merged.select("doc_id", F.size("s").alias("sections"), F.md5(F.array_join("s", "|")).alias("digest"))


@suite.add("SELECT doc_id, md5('![image]() ' || text || ' ![image]()') AS digest FROM documents")
def images_removed(spark, sf):
    """Base64 images put around every text are removed again."""
    image = F.concat(F.lit("![image](data:image/png;base64,"), F.base64(F.encode("lang", "UTF-8")), F.lit(")"))
    framed = F.concat(image, F.lit(" "), "text", F.lit(" "), image)
    docs = spread(table(spark, sf, "documents"))
    return docs.select("doc_id", F.md5(tx.strip_data_images(framed)).alias("digest"))


@suite.add(f"""
WITH RECURSIVE t AS (
  SELECT doc_id, i, s, regexp_extract_all(s, '{SPACED_SQL}') AS toks FROM (
    SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM (
      SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?\n]+[.!?]*|[.!?]+'),
               lambda x: {trim_sql('x')}), lambda x: x <> '') AS ss FROM documents))),
w AS (
  SELECT doc_id, i, 0 AS j, s AS text, len(toks) AS n FROM t WHERE len(toks) <= 500
  UNION ALL
  SELECT doc_id, i, j, {trim_sql("array_to_string(list_slice(toks, j + 1, j + 500), '')")}, least(500, len(toks) - j)
  FROM (SELECT *, unnest(range(0, len(toks), 500)) AS j FROM t WHERE len(toks) > 500)),
k AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS r, [{{'t': text, 'n': n}}] AS p, n FROM w),
f AS (
  SELECT doc_id, r, p AS cur, CAST(n AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS done FROM k WHERE r = 1
  UNION ALL
  SELECT doc_id, r, CASE WHEN p IS NULL THEN NULL WHEN fits THEN cur || p ELSE cur[len(cur) - tail + 1:] || p END,
         CASE WHEN fits THEN n + pn ELSE pn + coalesce(list_sum(list_transform(cur[len(cur) - tail + 1:], lambda x: x.n)), 0) END,
         CASE WHEN fits THEN NULL ELSE array_to_string(list_transform(cur, lambda x: x.t), ' ') END
  FROM (SELECT f.doc_id, f.r + 1 AS r, cur, f.n, p, k.n AS pn, coalesce(f.n + k.n <= 500, false) AS fits,
               list_max([m FOR m IN range(0, len(cur) + 1)
                         IF coalesce(list_sum(list_transform(cur[len(cur) - m + 1:], lambda x: x.n)), 0) <= least(10, 500 - k.n)]) AS tail
        FROM f LEFT JOIN k ON k.doc_id = f.doc_id AND k.r = f.r + 1 WHERE cur IS NOT NULL))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY r) - 1 AS INT) AS pos,
       CAST(len(regexp_extract_all(done, '{TOKEN_SQL}')) AS INT) AS n_tokens, md5(done) AS digest
FROM f WHERE done IS NOT NULL
""")
def sentence_chunks(spark, sf):
    chunks = chunking.chunk_sentences(spread(table(spark, sf, "documents")), "text", ["doc_id"])
    return chunks.select("doc_id", "pos", "n_tokens", F.md5("content").alias("digest"))


EMBED_DIM = 64


def embedding_sql(source: str, id: str, text: str = "text", dim: int = EMBED_DIM) -> str:
    """Hashed bag of tokens of a relation: id, slot, weight (float as double)."""
    return f"""
SELECT {id}, slot, CAST(CAST(w / sqrt(sum(w * w) OVER (PARTITION BY {id})) AS FLOAT) AS DOUBLE) AS weight FROM (
  SELECT {id}, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % {dim} AS slot,
         CAST(sum(CASE WHEN substr(h, 32, 1) < '8' THEN 1 ELSE -1 END) AS DOUBLE) AS w
  FROM (SELECT {id}, md5(unnest(regexp_extract_all(lower({text}), '{TOKEN_SQL}'))) AS h FROM ({source}))
  GROUP BY ALL) WHERE w <> 0
"""


@suite.add(f"""
SELECT doc_id, CAST(slot AS INT) AS slot, round(weight, 6) AS weight
FROM ({embedding_sql('SELECT doc_id, text FROM documents', 'doc_id')})
""")
def text_embeddings(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    index = embedding.build_index(embedding.embed(docs, "text", dim=EMBED_DIM), "doc_id", dim=EMBED_DIM)
    long = index.select(F.col("id").alias("doc_id"), F.posexplode("embedding").alias("slot", "weight"))
    return long.filter("weight <> 0").withColumn("weight", F.round(F.col("weight").cast("double"), 6))


@suite.add(
    f"""SELECT md5(concat_ws('|', doc_id, pos, content)) AS id, doc_id
FROM ({windows_sql('SELECT doc_id, text FROM documents', 'doc_id')})"""
)
def chunk_keys(spark, sf):
    chunks = chunking.chunk_windows(spread(table(spark, sf, "documents")), "text", ["doc_id"])
    return with_chunk_id(chunks, "doc_id").select("id", "doc_id")
