import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corpusloom.functions import vectors
from corpusloom.operators import embedding, index_sync, retrieval
from corpusloom.plans.workspace import fresh_path


def frame(spark, matrix, name="id"):
    rows = [(n, [float(x) for x in v]) for n, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} bigint, embedding array<float>").repartition(3)


def brute_force(q, x, k, exclude_self=False):
    q, x = q.astype(np.float32).astype(float), x.astype(np.float32).astype(float)
    q = q / np.linalg.norm(q, axis=1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for n, row in enumerate(np.round(q @ x.T, 6)):
        order = [m for m in np.lexsort((np.arange(len(x)), -row)) if not (exclude_self and m == n)]
        out[n] = order[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    # A third of the index are copies of one vector: ties all around, decided by id.
    x[::3] = x[0]
    return x


@pytest.mark.parametrize("block_bytes", [1 << 26, 2000])
def test_exact_neighbours(spark, data, block_bytes):
    """One block, and a grid of some ten by ten blocks."""
    q, i = frame(spark, data, "query_id"), frame(spark, data)
    got = found(retrieval.knn(q, i, 5, exclude_self=True, block_bytes=block_bytes))
    assert got == brute_force(data, data, 5, True)


def test_fewer_rows_than_asked_for(spark, data):
    q, i = frame(spark, data[:4], "query_id"), frame(spark, data[1:3])
    assert {k: len(v) for k, v in found(retrieval.knn(q, i, 5)).items()} == {n: 2 for n in range(4)}


def test_string_ids_and_inner_product(spark, data):
    q = frame(spark, data[:5], "query_id").withColumn("query_id", F.concat(F.lit("q"), "query_id"))
    i = frame(spark, data).withColumn("id", F.format_string("d%03d", "id"))
    got = found(retrieval.knn(q, i, 2, metric="inner"))
    sims = np.round(data[:5].astype(np.float32).astype(float) @ data.astype(np.float32).astype(float).T, 6)
    want = {f"q{n}": [f"d{m:03d}" for m in np.lexsort((np.arange(300), -row))[:2]] for n, row in enumerate(sims)}
    assert got == want


@pytest.mark.parametrize("block_bytes", [1 << 26, 1000])
def test_all_cells_probed_is_exact(spark, data, block_bytes):
    """Probing every cell gives the exact result, also when a hot cell is cut into blocks."""
    q, i = frame(spark, data, "query_id"), frame(spark, data)
    cells = retrieval.train_cells(i, 6)
    load = retrieval.cell_load(q.withColumnRenamed("query_id", "id"), i, cells, 6).collect()
    assert max(r["index_rows"] for r in load) >= 100
    got = retrieval.knn_cells(q, i, 5, cells, 6, exclude_self=True, block_bytes=block_bytes)
    assert found(got) == brute_force(data, data, 5, True)


def test_stored_cells_are_used(spark, data):
    q, i = frame(spark, data[:20], "query_id"), frame(spark, data)
    cells = retrieval.train_cells(i, 6)
    stored = retrieval.assign_cells(i, cells)
    a = found(retrieval.knn_cells(q, i, 3, cells, 2))
    assert found(retrieval.knn_cells(q, stored, 3, cells, 2)) == a


@pytest.mark.parametrize("cells,probe,recall,share", [(16, 4, 0.647, 0.332), (32, 8, 0.731, 0.388), (32, 12, 0.856, 0.557)])
def test_recall_of_cells(spark, cells, probe, recall, share):
    """Recall as measured, always with the share of pairs compared: the vectors have no clusters,
    so recall follows the share, and cells of uneven size compare more than probe / cells."""
    vecs = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    q = vecs.select(F.col("vec_id").alias("query_id"), "embedding")
    i = vecs.select(F.col("vec_id").alias("id"), "embedding")
    centroids = retrieval.train_cells(i, cells)
    exact = retrieval.knn(q, i, 10, exclude_self=True)
    near = retrieval.knn_cells(q, i, 10, centroids, probe, exclude_self=True)
    pairs = retrieval.cell_load(q, i, centroids, probe).agg(F.sum("pairs")).head()[0]
    assert abs(retrieval.recall_report(near, exact).head()["recall"] - recall) < 0.05
    assert abs(pairs / 500**2 - share) < 0.05


def test_no_cross_join_and_no_broadcast_of_vectors(spark, data):
    q, i = frame(spark, data, "query_id"), frame(spark, data)
    plan = plan_of(retrieval.knn(q, i, 5))
    assert "CartesianProduct" not in plan and "Broadcast" not in plan
    assert plan.count("WindowGroupLimit") == 2


def test_vector_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 0.0])], "a array<float>, b array<float>")
    row = df.select(vectors.dot(F.col("a"), F.col("b")), vectors.cosine(F.col("a"), F.col("b"))).head()
    assert row[0] == 2.0 and abs(row[1] - 1 / 5**0.5) < 1e-9


def test_retrieve_and_context(spark, data):
    q, i = frame(spark, data[1:3], "query_id"), frame(spark, data)
    docs = spark.createDataFrame([(n, f"u{n % 2}", f"text {n}") for n in range(300)], "id bigint, url string, content string")
    hits = retrieval.retrieve(q, i, docs, 3)
    assert hits.columns == ["query_id", "rank", "score", "id", "url", "content"]
    questions = spark.createDataFrame([(0, "why"), (1, "how"), (7, "none")], "query_id bigint, question string")
    rows = {r["query_id"]: r for r in retrieval.assemble_context(hits, questions, url="url").collect()}
    first = [r["content"] for r in hits.filter("query_id = 0").orderBy("rank").collect()]
    assert rows[0]["prompt"] == "why\n\n" + "\n\n".join(first)
    assert rows[7]["prompt"] == "none\n\n"
    assert rows[0]["sources"] == sorted(set(rows[0]["sources"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(retrieval.retrieve(q, i, docs, 3).collect()) == sorted(hits.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_backend_batches_keep_order(spark):
    def backend(texts):
        assert len(texts) <= 150
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([("x" * (n % 17),) for n in range(700)], "t string").coalesce(1)
    out = embedding.embed(df, "t", backend, dim=2)
    assert all(r["embedding"] == [len(r["t"]), 1.0] for r in out.collect())
    # A filter on the result does not run the backend a second time.
    assert plan_of(out.filter(F.col("embedding")[0] > 3)).count("ArrowEvalPython [") == 1


def test_backend_errors_fail_the_task(spark):
    def broken(texts):
        raise RuntimeError("model is down")

    with pytest.raises(Exception, match="model is down"):
        embedding.embed(spark.createDataFrame([("a",)], "t string"), "t", broken).collect()
    with pytest.raises(Exception, match="returned 0 vectors"):
        embedding.embed(spark.createDataFrame([("a",)], "t string"), "t", lambda t: []).collect()


def test_dimension_contract(spark, data):
    i = frame(spark, data)
    assert embedding.build_index(i, "id", dim=8).count() == 300
    with pytest.raises(Exception, match="expected 9 dimensions"):
        embedding.build_index(i, "id", dim=9).collect()


def test_empty_text_has_a_zero_vector(spark):
    df = spark.createDataFrame([("",), ("a b",), (None,)], "t string").coalesce(1)
    rows = [r["embedding"] for r in embedding.embed(df, "t", dim=16).collect()]
    assert rows[0] == [0.0] * 16 and abs(sum(x * x for x in rows[1]) - 1) < 1e-6 and rows[2] == [0.0] * 16


def test_index_follows_its_source(spark):
    root = fresh_path(spark, "index")
    built = []

    def build(df):
        built.append(1)
        hashed = df.withColumn("content_hash", index_sync.content_hash(["content"]))
        return embedding.embed(hashed, "content", dim=8).select("id", "content", "embedding", "content_hash")

    def source(rows):
        return spark.createDataFrame(rows, "id string, content string")

    def counts(rows):
        return {r["_change_type"]: r["count"] for r in index_sync.sync_index(source(rows), root, "id", ["content"], build).collect()}

    assert counts([("a", "one"), ("b", "two"), ("c", "three")]) == {"insert": 3}
    assert counts([("a", "one"), ("b", "2"), ("d", "four")]) == {"update": 1, "insert": 1, "delete": 1}
    index = index_sync.current_version(spark, root)
    assert {(r["id"], r["content"]) for r in index.collect()} == {("a", "one"), ("b", "2"), ("d", "four")}
    before = len(built)
    assert counts([("a", "one"), ("b", "2"), ("d", "four")]) == {}
    assert len(built) == before
    hit = retrieval.search_text(
        spark.createDataFrame([(1, "four")], "query_id int, text string"), index, 1, dim=8
    ).head()
    assert hit["id"] == "d"


def test_column_borders_count_in_the_diff(spark):
    old = spark.createDataFrame([(1, "ab", "c"), (2, None, ""), (3, "x", "y")], "id int, a string, b string")
    new = spark.createDataFrame([(1, "a", "bc"), (2, "", None), (3, "x", "y")], "id int, a string, b string")
    changed = index_sync.diff_snapshots(old, new, "id", ["a", "b"]).collect()
    assert {(r["id"], r["_change_type"]) for r in changed} == {(1, "update"), (2, "update")}


@pytest.mark.parametrize("bad", [[1.0, float("nan")], [1.0, float("inf")], [1.0], [1.0, 2.0, 3.0], [1.0, None]])
def test_unfit_vectors_fail(spark, bad):
    schema = "id int, embedding array<double>"
    index = spark.createDataFrame([(1, [1.0, 0.0]), (2, bad)], schema)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<double>")
    with pytest.raises(Exception, match="vectors"):
        retrieval.knn(queries, index, 1, block_bytes=1 << 20).collect()


def test_retrieval_in_cells_keeps_hits_without_a_document(spark):
    index = spark.createDataFrame([(n, [float(n % 2), float((n + 1) % 2)]) for n in range(10)], "id int, embedding array<double>")
    queries = index.select(F.col("id").alias("query_id"), "embedding").filter("id < 2")
    docs = spark.createDataFrame([(n, f"d{n}") for n in range(4)], "id int, content string")
    cells = retrieval.Centroids(spark.createDataFrame([(0, [0.0, 1.0]), (1, [1.0, 0.0])], "cell int, centroid array<double>"))
    options = {"k": 5, "columns": ("id", "content"), "cells": cells, "probe": 1}
    every = retrieval.retrieve(queries, index, docs, how="left", **options).collect()
    assert len(every) == 10 and sum(r["content"] is None for r in every) == 6
    assert retrieval.retrieve(queries, index, docs, **options).count() == 4
    assert all(r["id"] % 2 == r["query_id"] for r in every)


def test_a_block_is_compared_in_bounded_pieces():
    """Beside the vectors a task holds a few similarities at a time, whatever the size of the index."""
    rng = np.random.default_rng(4)
    sides = [(rng.normal(size=(n, 16)).astype(np.float32), start) for n, start in ((1500, 0), (20_000, 1000))]
    tables = [
        pa.table({i: np.arange(start, start + len(x)), v: pa.FixedSizeListArray.from_arrays(x.ravel(), 16).cast(pa.list_(pa.float32()))})
        for (x, start), (i, v) in zip(sides, (("query_id", "q_vector"), ("id", "i_vector")))
    ]
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
    tracemalloc.start()
    got = retrieval._best_of_block(2, "cosine", True, schema)(*tables).to_pandas()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    unit = [x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True) for x, _ in sides]
    sims = np.round(unit[0][1200:1210] @ unit[1].T, 6)
    sims[np.arange(10), np.arange(200, 210)] = -1
    for query, row in zip(range(1200, 1210), sims):
        want = np.argsort(-row, kind="stable")[:2] + 1000
        assert set(got[got.query_id == query].id) == set(want)


def test_query_blocks_are_bounded_by_what_they_give_back():
    most = retrieval.RESULT_BYTES // retrieval.RESULT_ROW
    assert retrieval._query_blocks(most, 2, 1, retrieval.BLOCK_BYTES) == 1
    assert retrieval._query_blocks(most, 2, 50, retrieval.BLOCK_BYTES) == 50
