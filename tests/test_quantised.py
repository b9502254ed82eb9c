"""Search in quantised cells against brute force: exact by bounds, and recall with a fixed number of re-ranked codes."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_retrieval import brute_force, found, frame

from corpusloom.operators import quantised, retrieval


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(9, 12)) * 4
    x = centers[rng.integers(0, 9, 600)] + rng.normal(size=(600, 12))
    # A quarter of the rows are copies of one vector: one hot cell, ties decided by id.
    x[::4] = x[0]
    return x


@pytest.mark.parametrize("parts", [3, 12])
@pytest.mark.parametrize("probe", [1, 20])
def test_bounds_keep_every_neighbour(spark, data, parts, probe):
    q, i = frame(spark, data[:80], "query_id"), frame(spark, data)
    quantiser = quantised.fit_quantiser(i, 9, parts)
    got = quantised.search_quantised(q, i, 5, quantiser, probe=probe, exclude_self=True)
    assert found(got) == brute_force(data[:80], data, 5, True)


def test_hot_cells_are_cut_into_blocks(spark, data):
    q, i = frame(spark, data[:50], "query_id"), frame(spark, data)
    quantiser = quantised.fit_quantiser(i, 4, 6)
    got = quantised.search_quantised(q, i, 5, quantiser, probe=1, exclude_self=True, block_bytes=1500)
    assert found(got) == brute_force(data[:50], data, 5, True)


def test_bounds_leave_most_vectors_unread(spark, data):
    rows = np.unique(data, axis=0)
    q = frame(spark, rows, "query_id").withColumnRenamed("embedding", "q_vector")
    i = frame(spark, rows)
    quantiser = quantised.fit_quantiser(i, 9, 12)
    codes = quantised.encode_index(i, quantiser)
    compared = quantised.candidates(q, codes, quantiser, 10, 1, None, True).count()
    assert 10 * len(rows) <= compared < 0.15 * len(rows) ** 2


def test_codes_are_within_their_error(data):
    quantiser = quantised.Quantiser(data[:4], np.array_split(np.arange(12), 5), [np.unique(data[:200, c], axis=0) for c in np.array_split(np.arange(12), 5)], False)
    cells, codes, error, reach = quantiser.encode(data)
    for n in range(0, 600, 37):
        back = data[:4][cells[n]].copy()
        for c, book, level in zip(quantiser.columns, quantiser.books, codes[n], strict=True):
            back[c] += book[level]
        assert np.linalg.norm(data[n] - back) <= error[n] and np.linalg.norm(data[n] - data[:4][cells[n]]) <= reach[n]


def test_recall_on_vectors_without_clusters(spark):
    """The figures that the README gives: recall from 0.9 with at most 15 % of the full vectors compared."""
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    q, i = vectors.select(F.col("vec_id").alias("query_id"), "embedding"), vectors.select(F.col("vec_id").alias("id"), "embedding")
    quantiser = quantised.fit_quantiser(i, 16, 16)
    hits = quantised.search_quantised(q, i, 10, quantiser, probe=12, rerank=60, exclude_self=True)
    report = retrieval.recall_report(hits, retrieval.knn(q, i, 10, exclude_self=True)).first()
    assert report["recall"] >= 0.9 and 60 / i.count() <= 0.15


def test_euclidean_strings_and_few_rows(spark, data):
    q = frame(spark, data[:6], "query_id").withColumn("query_id", F.concat(F.lit("q"), "query_id"))
    i = frame(spark, data[:6]).withColumn("id", F.concat(F.lit("d"), "id")).unionByName(
        spark.createDataFrame([("none", None)], "id string, embedding array<float>")
    )
    quantiser = quantised.fit_quantiser(i, 3, 4, metric="euclidean")
    got = quantised.search_quantised(q, i, 9, quantiser, probe=1)
    far = np.linalg.norm(data[:6, None].astype(np.float32) - data[None, :6].astype(np.float32), axis=2)
    want = {f"q{n}": [f"d{m}" for m in np.lexsort((np.arange(6), np.round(row, 5)))] for n, row in enumerate(far)}
    assert found(got) == want
    with pytest.raises(ValueError):
        quantised.fit_quantiser(i, 3, 4, metric="inner")
    with pytest.raises(ValueError):
        quantised.fit_quantiser(i.limit(0), 3, 4)
