"""Nearest neighbours, retrieval and index synchronisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import embedding, index_sync, quantised, retrieval
from corpusloom.plans.parallelism import spread
from corpusloom.plans.workspace import fresh_path, materialize
from corpusloom.suite import Suite, table
from corpusloom.suite.corpus import EMBED_DIM, embedding_sql

suite = Suite()

_VECTORS = "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"

_RANKED = """
SELECT query_id, id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INT) AS rank
"""


def _exact(k: int) -> str:
    return f"""
x AS (SELECT * FROM ({_RANKED} FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS id, round(list_cosine_similarity(a.v, b.v), 6) AS score
  FROM e a, e b WHERE a.vec_id <> b.vec_id)) WHERE rank <= {k})"""


# Cells are the label means; every vector belongs to its nearest cell and probes its three nearest.
_CELLS = """
c AS (SELECT cell, list(m ORDER BY i) AS c FROM (
  SELECT label AS cell, i, avg(x) AS m FROM (
    SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(64)) AS i FROM embeddings) GROUP BY label, i)
  GROUP BY cell),
g AS (SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY
        round(list_inner_product(c, c) - 2 * list_inner_product(v, c), 6), cell) AS near FROM e, c),
p AS (SELECT * FROM ({ranked} FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS id, round(list_cosine_similarity(ea.v, eb.v), 6) AS score
  FROM g a JOIN g b ON a.cell = b.cell AND a.near <= 3 AND b.near = 1 AND a.vec_id <> b.vec_id
  JOIN e ea ON ea.vec_id = a.vec_id JOIN e eb ON eb.vec_id = b.vec_id)) WHERE rank <= {k})"""


def _vectors(spark, sf):
    return spread(table(spark, sf, "embeddings"))


def _sides(spark, sf):
    vectors = _vectors(spark, sf)
    queries = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    index = vectors.select(F.col("vec_id").alias("id"), "embedding")
    return queries, index


def _label_cells(spark, sf):
    vectors = _vectors(spark, sf)
    means = (
        vectors.select("label", F.posexplode("embedding").alias("i", "x"))
        .groupBy("label", "i")
        .agg(F.avg(F.col("x").cast("double")).alias("m"))
    )
    # One short list per label.
    listed = F.sort_array(F.collect_list(F.struct("i", "m")))
    return means.groupBy(F.col("label").alias("cell")).agg(F.transform(listed, lambda s: s["m"]).alias("centroid"))


@suite.add(f"WITH {_VECTORS}, {_exact(5)} SELECT query_id, id, score, rank FROM x")
def nearest_exact(spark, sf):
    queries, index = _sides(spark, sf)
    return retrieval.knn(queries, index, 5, exclude_self=True)


@suite.add(f"WITH {_VECTORS}, {_CELLS.format(ranked=_RANKED, k=5)} SELECT query_id, id, score, rank FROM p")
def nearest_in_cells(spark, sf):
    queries, index = _sides(spark, sf)
    return retrieval.knn_cells(queries, index, 5, _label_cells(spark, sf), probe=3, exclude_self=True)


@suite.add(f"""
WITH {_VECTORS}, {_exact(10)}, {_CELLS.format(ranked=_RANKED, k=10)}
SELECT (SELECT count(*) FROM x) AS neighbours,
       round((SELECT count(*) FROM x JOIN p USING (query_id, id)) / (SELECT count(*) FROM x), 6) AS recall,
       (SELECT CAST(count(*) AS BIGINT) FROM g a JOIN g b ON a.cell = b.cell AND a.near <= 3 AND b.near = 1) AS pairs,
       round((SELECT count(*) FROM g a JOIN g b ON a.cell = b.cell AND a.near <= 3 AND b.near = 1)
             / (SELECT count(*) * count(*) FROM e), 6) AS share
""")
def recall_in_cells(spark, sf):
    """Recall of the ten nearest, with the share of pairs that were compared."""
    queries, index = _sides(spark, sf)
    cells = retrieval.Centroids(_label_cells(spark, sf))
    found = retrieval.knn_cells(queries, index, 10, cells, probe=3, exclude_self=True)
    exact = retrieval.knn(queries, index, 10, exclude_self=True)
    load = retrieval.cell_load(queries, index, cells, 3).agg(F.sum("pairs").alias("pairs"))
    size = index.count()
    report = retrieval.recall_report(found, exact).withColumn("pairs", load.scalar())
    return report.select(
        "neighbours",
        F.round("recall", 6).alias("recall"),
        "pairs",
        F.round(F.col("pairs") / F.lit(size * size), 6).alias("share"),
    )


@suite.add(f"""
WITH {_VECTORS}, {_CELLS.format(ranked=_RANKED, k=1)}
SELECT vec_id, label, CAST(cell AS INT) AS cell FROM g JOIN embeddings USING (vec_id) WHERE near = 1
""")
def nearest_class(spark, sf):
    """Class by nearest label centroid."""
    assigned = retrieval.assign_cells(_vectors(spark, sf), _label_cells(spark, sf))
    return assigned.select("vec_id", "label", "cell")


@suite.add(f"""
WITH {_VECTORS}, {_exact(5)}
SELECT query_id, rank, score, id, source, n_chars FROM x JOIN documents ON id = doc_id
""")
def retrieved_documents(spark, sf):
    queries, index = _sides(spark, sf)
    docs = table(spark, sf, "documents")
    return retrieval.retrieve(
        queries, index, docs, 5, ["id", "source", "n_chars"], doc_id="doc_id", exclude_self=True
    )


@suite.add(f"""
WITH {_VECTORS}, {_CELLS.format(ranked=_RANKED, k=5)}
SELECT query_id, rank, score, id, source, n_chars FROM p LEFT JOIN documents ON id = doc_id
""")
def retrieved_in_cells(spark, sf):
    """Approximate search behind the retriever; hits without a document stay."""
    queries, index = _sides(spark, sf)
    cells = retrieval.Centroids(_label_cells(spark, sf))
    return retrieval.retrieve(
        queries, index, table(spark, sf, "documents"), 5, ["id", "source", "n_chars"], doc_id="doc_id", how="left",
        cells=cells, probe=3, exclude_self=True,
    )


@suite.add(f"""
WITH {_VECTORS}, {_exact(5)}
SELECT query_id, rank, score, id, source, n_chars FROM x LEFT JOIN documents ON id = doc_id
""")
def retrieved_by_codes(spark, sf):
    """The retriever over quantised cells: codes leave out what their bounds exclude, so that the hits are exact."""
    queries, index = _sides(spark, sf)
    quantiser = quantised.fit_quantiser(index, 8, 64)
    codes = materialize(quantised.encode_index(index, quantiser), "codes")
    return retrieval.retrieve(
        queries, index, table(spark, sf, "documents"), 5, ["id", "source", "n_chars"], doc_id="doc_id", how="left",
        quantiser=quantiser, codes=codes, probe=2, exclude_self=True,
    )


@suite.add(f"WITH {_VECTORS}, {_exact(10)} SELECT count(*) AS neighbours, 0.9::DOUBLE AS recall_from, 0.15::DOUBLE AS share_to FROM x")
def recall_by_codes(spark, sf):
    """Recall of the ten nearest among 60 re-ranked codes (0.9, if no less) and the share of full vectors compared (0.15, if no more)."""
    queries, index = _sides(spark, sf)
    quantiser = quantised.fit_quantiser(index, 16, 16)
    codes = materialize(quantised.encode_index(index, quantiser), "codes")
    found = quantised.search_quantised(queries, index, 10, quantiser, codes, probe=12, rerank=60, exclude_self=True)
    exact = retrieval.knn(queries, index, 10, exclude_self=True)
    size = index.count()
    return retrieval.recall_report(found, exact).select(
        "neighbours",
        F.least(F.lit(0.9), F.round("recall", 3)).alias("recall_from"),
        F.greatest(F.lit(0.15), F.lit(60 / size)).alias("share_to"),
    )


@suite.add("SELECT count(*) AS vectors, CAST(count(*) AS DOUBLE) AS probed FROM embeddings")
def trained_cells(spark, sf):
    """Cells trained on the table hold every vector once, and so do the nearest cells of all vectors."""
    queries, index = _sides(spark, sf)
    cells = retrieval.Centroids(retrieval.train_cells(index, 8))
    load = retrieval.cell_load(queries, index, cells, 1)
    return load.agg(F.sum("index_rows").alias("vectors"), F.sum("queries").cast("double").alias("probed"))


@suite.add(f"""
WITH {_VECTORS}, {_exact(3)},
h AS (SELECT query_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context,
             array_to_string(list_sort(list_distinct(list(source))), ',') AS sources
      FROM x JOIN documents ON id = doc_id GROUP BY query_id)
SELECT vec_id AS query_id, coalesce(sources, '') AS sources,
       md5('Use the context.' || chr(10) || coalesce(context, '') || chr(10) || 'Question: what is close to ' || vec_id || '?') AS digest
FROM embeddings LEFT JOIN h ON vec_id = query_id
""")
def context_prompts(spark, sf):
    queries, index = _sides(spark, sf)
    docs = table(spark, sf, "documents")
    hits = retrieval.retrieve(
        queries, index, docs, 3, ["id", "source", "text"], doc_id="doc_id", exclude_self=True
    )
    questions = queries.select(
        "query_id", F.concat(F.lit("what is close to "), F.col("query_id").cast("string"), F.lit("?")).alias("question")
    )
    prompts = retrieval.assemble_context(
        hits, questions, "Use the context.\n{context}\nQuestion: {question}", content="text", url="source"
    )
    sources = F.coalesce(F.array_join("sources", ","), F.lit(""))
    return prompts.select("query_id", sources.alias("sources"), F.md5("prompt").alias("digest"))


@suite.add(f"""
WITH q AS ({embedding_sql('SELECT item_id, text FROM benchmark', 'item_id')}),
d AS ({embedding_sql('SELECT doc_id, text FROM documents', 'doc_id')}),
s AS (SELECT item_id AS query_id, doc_id AS id, sum(q.weight * d.weight) AS dot FROM q JOIN d USING (slot) GROUP BY ALL),
qn AS (SELECT item_id AS query_id, sqrt(sum(weight * weight)) AS qn FROM q GROUP BY ALL),
dn AS (SELECT doc_id AS id, sqrt(sum(weight * weight)) AS dn FROM d GROUP BY ALL)
SELECT * FROM ({_RANKED} FROM (
  SELECT query_id, id, round(dot / qn / dn, 6) + 0 AS score FROM s JOIN qn USING (query_id) JOIN dn USING (id)))
WHERE rank <= 3
""")
def text_search(spark, sf):
    """Benchmark passages searched in all documents."""
    docs = spread(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"))
    index = embedding.embed(docs, "text", dim=EMBED_DIM).select("id", "embedding")
    passages = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return retrieval.search_text(passages, index, 3, dim=EMBED_DIM)


def _snapshots(spark, sf):
    """German texts are new, Spanish ones gone, French ones revised."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    revised = F.when(F.col("lang") == "fr", F.concat("text", F.lit(" (revised)"))).otherwise(F.col("text"))
    old = docs.filter("NOT lang <=> 'de'").drop("lang")
    new = docs.filter("NOT lang <=> 'es'").withColumn("text", revised).drop("lang")
    return old, new


@suite.add("""
SELECT doc_id, md5(CASE lang WHEN 'fr' THEN text || ' (revised)' WHEN 'de' THEN text END) AS digest,
       CASE lang WHEN 'de' THEN 'insert' WHEN 'es' THEN 'delete' WHEN 'fr' THEN 'update' END AS change
FROM documents WHERE lang IN ('de', 'es', 'fr')
""")
def snapshot_changes(spark, sf):
    old, new = _snapshots(spark, sf)
    changes = index_sync.diff_snapshots(old, new, "doc_id", ["text"])
    return changes.select("doc_id", F.md5("text").alias("digest"), F.col("_change_type").alias("change"))


@suite.add("""
SELECT doc_id, md5(CASE lang WHEN 'fr' THEN text || ' (revised)' ELSE text END) AS digest
FROM documents WHERE lang IS DISTINCT FROM 'es'
""")
def synced_index(spark, sf):
    old, new = _snapshots(spark, sf)
    changes = index_sync.diff_snapshots(old, new, "doc_id", ["text"])
    return index_sync.apply_changes(old, changes, "doc_id").select("doc_id", F.md5("text").alias("digest"))


@suite.add("""
SELECT * FROM (VALUES ('first', 'insert'), ('second', 'insert'), ('second', 'update'), ('second', 'delete')) AS v(run, change)
JOIN (SELECT 'first' AS run, 'insert' AS change, count_if(lang IS DISTINCT FROM 'de') AS count FROM documents
      UNION ALL SELECT 'second', 'insert', count_if(lang = 'de') FROM documents
      UNION ALL SELECT 'second', 'update', count_if(lang = 'fr') FROM documents
      UNION ALL SELECT 'second', 'delete', count_if(lang = 'es') FROM documents) USING (run, change)
""")
def index_syncs(spark, sf):
    """Change counts of a first build, of a sync after changes and of a third run, which has none."""
    old, new = _snapshots(spark, sf)
    root, out = fresh_path(spark, "index"), None
    for run, source in (("first", old), ("second", new), ("third", new)):
        counts = index_sync.sync_index(source, root, "doc_id", ["text"], _with_hash)
        part = materialize(counts, "sync-counts").select(F.lit(run).alias("run"), F.col("_change_type").alias("change"), "count")
        out = part if out is None else out.unionByName(part)
    return out


@suite.add("""
SELECT doc_id, md5(CASE lang WHEN 'fr' THEN text || ' (revised)' ELSE text END) AS digest
FROM documents WHERE lang IS DISTINCT FROM 'es'
""")
def merged_index(spark, sf):
    """An index of a base and its deltas, one by language, read as they stand after the last of four syncs."""
    old, new = _snapshots(spark, sf)
    root, french = fresh_path(spark, "index"), F.col("text").endswith(" (revised)")
    gone = old.join(new.select("doc_id"), "doc_id", "left_semi")
    for source in (old, gone, gone.unionByName(new.filter(french)).dropDuplicates(["doc_id"]), new):
        index_sync.sync_index(source, root, "doc_id", ["text"], _with_hash)
    return index_sync.current_version(spark, root, "doc_id").select("doc_id", F.md5("text").alias("digest"))


def _with_hash(rows):
    return rows.withColumn(index_sync.HASH_COLUMN, index_sync.content_hash(["text"]))


@suite.add("SELECT 0 AS remaining")
def resync_is_empty(spark, sf):
    """After applying the changes a second comparison finds none."""
    old, new = _snapshots(spark, sf)
    synced = index_sync.apply_changes(old, index_sync.diff_snapshots(old, new, "doc_id", ["text"]), "doc_id")
    rest = index_sync.diff_snapshots(synced, new, "doc_id", ["text"])
    return rest.agg(F.count(F.lit(1)).cast("int").alias("remaining"))
