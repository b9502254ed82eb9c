"""Nearest-neighbour search, retrieval and context assembly.

Vectors are compared block by block: queries and index rows are spread over a
grid by a hash of their ids, each grid cell multiplies two matrices of bounded
size inside a task and emits only its best k rows per query, and the best of
those are picked per query. No pair table is built and no side is broadcast,
so neither side has to be small.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.functions.vectors import as_matrix, scale_rows
from corpusloom.operators.embedding import Backend, embed
from corpusloom.operators.prompts import render_prompt
from corpusloom.plans.skew import first_per_key, skew_join

# Bytes of one block of vectors in double precision. A task holds some eight times that: both sides as they came,
# sorted and as matrices.
BLOCK_BYTES = 16 * 1024 * 1024
# Bytes of the similarities that a task holds at once, some four times over.
SCORE_BYTES = 8 * 1024 * 1024
# Bytes of the best rows that a block of queries gives back: ids, places and scores, before and after they are put together.
RESULT_BYTES = 16 * 1024 * 1024
RESULT_ROW = 64
# Similarities are compared after rounding to this many decimals; ties go to the smaller id.
DECIMALS = 6


def _dimensions(df: DataFrame, vector: str) -> int:
    first = df.select(F.size(vector).alias("d")).head()
    return first["d"] if first else 1


def _blocks(rows: int, dim: int, block_bytes: int) -> int:
    return max(1, -(-rows * dim * 8 // block_bytes))


def _query_blocks(rows: int, dim: int, k: int, block_bytes: int) -> int:
    """Blocks of queries, bounded by their vectors and by the k rows that each of them gives back."""
    return max(_blocks(rows, dim, block_bytes), -(-rows * k * RESULT_ROW // RESULT_BYTES))


def _block_of(id: str, blocks: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.col(id)), F.lit(blocks) if isinstance(blocks, int) else blocks).cast("int")


def _best_of_block(k: int, metric: str, exclude_self: bool, schema: pa.Schema):
    """Top k of a query block against an index block, ties by id."""

    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        if queries.num_rows == 0 or index.num_rows == 0:
            return schema.empty_table()
        # Columns in id order, so that the first of equal scores is the one with the smaller id.
        index = index.sort_by("id")
        q, x = as_matrix(queries.column("q_vector")), as_matrix(index.column("i_vector"))
        if metric == "cosine":
            q, x = scale_rows(q), scale_rows(x)
        if exclude_self:
            column_of = {v: n for n, v in enumerate(index.column("id").to_pylist())}
            own = np.array([column_of.get(v, -1) for v in queries.column("query_id").to_pylist()])
            del column_of
        step = max(1, SCORE_BYTES // (8 * len(x)))
        rows, cols, scores = [], [], []
        for start in range(0, len(q), step):
            # Adding zero turns -0.0 into 0.0.
            sims = q[start : start + step] @ x.T
            np.round(sims, DECIMALS, out=sims)
            sims += 0.0
            if exclude_self:
                here = own[start : start + step]
                sims[np.flatnonzero(here >= 0), here[here >= 0]] = -np.inf
            kth = min(k, sims.shape[1])
            # A copy: the slice would keep the whole sorted array.
            edge = np.partition(sims, sims.shape[1] - kth, axis=1)[:, [sims.shape[1] - kth]].copy()
            chosen = sims >= edge
            # Copies of one vector tie in any number: of those at the edge only the first ids are kept.
            crowded = np.flatnonzero(chosen.sum(axis=1) > kth)
            if len(crowded):
                above = sims[crowded] > edge[crowded]
                ties = chosen[crowded] & ~above
                room = kth - above.sum(axis=1, keepdims=True)
                chosen[crowded] = above | (ties & (np.cumsum(ties, axis=1, dtype=np.int32) <= room))
            r, c = np.nonzero(chosen & (sims > -np.inf))
            values = sims[r, c]
            rows.append(r + start)
            cols.append(c)
            scores.append(values)
        r, c = np.concatenate(rows), np.concatenate(cols)
        return pa.table(
            [
                queries.column("query_id").take(pa.array(r)).cast(schema.field("query_id").type),
                index.column("id").take(pa.array(c)).cast(schema.field("id").type),
                pa.array(np.concatenate(scores), type=pa.float64()),
            ],
            schema=schema,
        )

    return run


def _grid_top_k(
    queries: DataFrame, index: DataFrame, keys: Sequence[str], k: int, metric: str, exclude_self: bool
) -> DataFrame:
    """Best k index rows per query over the grid cells given by ``keys``."""
    q_type = queries.schema["query_id"].dataType
    i_type = index.schema["id"].dataType
    schema = pa.schema(
        [("query_id", to_arrow_type(q_type)), ("id", to_arrow_type(i_type)), ("score", pa.float64())]
    )
    ddl = f"query_id {q_type.simpleString()}, id {i_type.simpleString()}, score double"
    local = (
        queries.groupBy(*keys)
        .cogroup(index.groupBy(*keys))
        .applyInArrow(_best_of_block(k, metric, exclude_self, schema), ddl)
    )
    return first_per_key(local, ["query_id"], [F.desc("score"), F.col("id")], k, rank="rank")


def _sides(queries: DataFrame, index: DataFrame, query_id: str, id: str, vector: str) -> tuple[DataFrame, DataFrame]:
    q = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("q_vector"))
    i = index.select(F.col(id).alias("id"), F.col(vector).alias("i_vector"))
    return q.filter(F.col("q_vector").isNotNull()), i.filter(F.col("i_vector").isNotNull())


def knn(
    queries: DataFrame,
    index: DataFrame,
    k: int = 1,
    metric: str = "cosine",
    query_id: str = "query_id",
    id: str = "id",
    vector: str = "embedding",
    exclude_self: bool = False,
    block_bytes: int = BLOCK_BYTES,
    dim: int | None = None,
) -> DataFrame:
    """Exact nearest neighbours: ``query_id, id, score, rank``.

    Counts both sides when called, to choose the number of blocks; without
    ``dim`` one vector is looked at. Exact search compares all pairs, and its
    shuffle grows with the product of the sides over ``block_bytes``: raise
    that with the memory of the executors, and use :func:`knn_cells` where
    many queries meet a large index.
    """
    q, i = _sides(queries, index, query_id, id, vector)
    # Counting reads no vectors, and of an index still to be computed no vector is computed.
    n_q, n_i, dim = queries.count(), index.count(), dim or _dimensions(i, "i_vector")
    # At least one block per core, so that a small index is still searched in parallel.
    cores = index.sparkSession.sparkContext.defaultParallelism
    q_blocks = _query_blocks(n_q, dim, k, block_bytes)
    i_blocks = max(_blocks(n_i, dim, block_bytes), min(cores, max(1, n_i // 256)))

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    q = q.withColumn("qb", _block_of("query_id", q_blocks)).withColumn("ib", every(i_blocks))
    i = i.withColumn("ib", _block_of("id", i_blocks)).withColumn("qb", every(q_blocks))
    return _grid_top_k(q, i, ["qb", "ib"], k, metric, exclude_self)


def search_text(
    queries: DataFrame,
    index: DataFrame,
    k: int = 1,
    backend: Backend | None = None,
    text: str = "text",
    dim: int = 1024,
    **options,
) -> DataFrame:
    """Nearest neighbours of texts: embed, then search; ``dim`` is the length of the vectors.

    With ``cells`` and ``probe`` the search is approximate (:func:`knn_cells`), with ``quantiser`` it goes
    through codes (:func:`corpusloom.operators.quantised.search_quantised`), else it is exact.
    """
    if "cells" not in options and "quantiser" not in options:
        options["dim"] = dim
    return _search(embed(queries, text, backend, dim), index, k, **options)


def _search(queries: DataFrame, index: DataFrame, k: int, **options) -> DataFrame:
    if "quantiser" in options:
        from corpusloom.operators.quantised import search_quantised

        return search_quantised(queries, index, k, **options)
    return (knn_cells if "cells" in options else knn)(queries, index, k, **options)


def train_cells(index: DataFrame, cells: int, seed: int = 7, vector: str = "embedding", max_iter: int = 10) -> DataFrame:
    """Cell centroids ``cell, centroid`` by distributed k-means."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    features = index.select(array_to_vector(F.col(vector)).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=max_iter).fit(features)
    rows = [(n, [float(x) for x in center]) for n, center in enumerate(model.clusterCenters())]
    return index.sparkSession.createDataFrame(rows, "cell int, centroid array<double>")


class Centroids:
    """Cell numbers and centers, fetched once; every task holds them, so the caller's number of cells bounds them."""

    def __init__(self, table: DataFrame) -> None:
        rows = table.select("cell", "centroid").orderBy("cell").collect()
        self.ids = np.array([r["cell"] for r in rows])
        self.centers = np.array([r["centroid"] for r in rows], dtype=np.float64)
        if not np.isfinite(self.centers).all():
            raise ValueError("centroids with NaN or infinite values")


def centroids_of(cells: DataFrame | Centroids) -> Centroids:
    return cells if isinstance(cells, Centroids) else Centroids(cells)


def _nearest_cells(cells: DataFrame | Centroids, probe: int):
    """Arrow UDF giving the ``probe`` nearest cells of each vector, nearest first."""
    known = centroids_of(cells)
    ids, centers = known.ids, known.centers
    lengths = (centers**2).sum(axis=1)
    take = min(probe, len(ids))

    @F.arrow_udf("array<int>")
    def nearest(vectors: pa.Array) -> pa.Array:
        x = as_matrix(vectors)
        if len(x) == 0:
            return pa.array([], type=pa.list_(pa.int32()))
        best = np.empty((len(x), take), dtype=np.int32)
        step = max(1, SCORE_BYTES // (8 * len(ids)))
        for start in range(0, len(x), step):
            # Squared distance without the query's own length, which does not change the order.
            gaps = np.round(lengths[None, :] - 2 * (x[start : start + step] @ centers.T), DECIMALS)
            best[start : start + step] = ids[np.argsort(gaps, axis=1, kind="stable")[:, :take]]
        offsets = np.arange(0, (len(x) + 1) * take, take, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(best.ravel()))

    # Not copied into the filters that Spark infers for the explode of its result.
    return nearest.asNondeterministic()


def assign_cells(index: DataFrame, centroids: DataFrame | Centroids, vector: str = "embedding") -> DataFrame:
    """Add the nearest cell of each index row; rows without a vector are left out, as nothing can find them."""
    there = index.filter(F.col(vector).isNotNull())
    return there.withColumn("cell", _nearest_cells(centroids, 1)(F.col(vector))[0])


def knn_cells(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    cells: DataFrame | Centroids,
    probe: int,
    metric: str = "cosine",
    query_id: str = "query_id",
    id: str = "id",
    vector: str = "embedding",
    exclude_self: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Approximate nearest neighbours: exact ranking within the ``probe`` nearest cells.

    ``cells`` are centroids from :func:`train_cells` or another source. An index
    stored with its ``cell`` column (:func:`assign_cells`) is used as it is. A cell
    holding much of the index is cut into as many blocks as its size asks for,
    and its queries likewise. Always quote recall together with the share of
    pairs compared (:func:`recall_report`).
    """
    cells = centroids_of(cells)
    q, i = _sides(queries, index, query_id, id, vector)
    rows_per_block = max(1, block_bytes // (8 * _dimensions(i, "i_vector")))
    q = q.withColumn("cell", F.explode(_nearest_cells(cells, probe)(F.col("q_vector"))))
    if "cell" in index.columns:
        i = index.select(F.col(id).alias("id"), F.col(vector).alias("i_vector"), "cell").filter("i_vector is not null")
    else:
        i = i.withColumn("cell", _nearest_cells(cells, 1)(F.col("i_vector"))[0])

    # One row per cell, as many as there are centroids in every task: small by construction.
    def parts(df: DataFrame, name: str, held: int) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(held)).cast("int").alias(name))

    queries_per_block = max(1, min(rows_per_block, RESULT_BYTES // (RESULT_ROW * k)))
    sizes = F.broadcast(parts(q, "q_parts", queries_per_block).join(parts(i, "i_parts", rows_per_block), "cell"))
    q = (
        q.join(sizes, "cell")
        .withColumn("qb", _block_of("query_id", F.col("q_parts")))
        .withColumn("ib", F.explode(F.sequence(F.lit(0), F.col("i_parts") - 1)))
    )
    i = (
        i.join(sizes, "cell")
        .withColumn("ib", _block_of("id", F.col("i_parts")))
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)))
    )
    return _grid_top_k(
        q.drop("q_parts", "i_parts"), i.drop("q_parts", "i_parts"), ["cell", "qb", "ib"], k, metric, exclude_self
    )


def cell_load(queries: DataFrame, index: DataFrame, cells: DataFrame | Centroids, probe: int, vector: str = "embedding") -> DataFrame:
    """Index rows, probing queries and compared pairs per cell: shows skewed cells."""
    cells = centroids_of(cells)
    q = queries.select(F.explode(_nearest_cells(cells, probe)(F.col(vector))).alias("cell"))
    i = index.select(_nearest_cells(cells, 1)(F.col(vector))[0].alias("cell"))
    return (
        i.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("index_rows"))
        .join(q.groupBy("cell").agg(F.count(F.lit(1)).alias("queries")), "cell", "left")
        .na.fill(0, ["queries"])
        .withColumn("pairs", F.col("index_rows") * F.col("queries"))
    )


def recall_report(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that were found."""
    found = approximate.select("query_id", "id", F.lit(1).alias("__found"))
    return exact.join(found, ["query_id", "id"], "left").agg(
        F.count(F.lit(1)).alias("neighbours"),
        F.avg(F.coalesce("__found", F.lit(0))).alias("recall"),
    )


def retrieve(
    queries: DataFrame,
    index: DataFrame,
    docs: DataFrame,
    k: int = 1,
    columns: Sequence[str] = ("id", "url", "content"),
    doc_id: str = "id",
    how: str = "inner",
    **options,
) -> DataFrame:
    """Nearest neighbours with chosen columns of the documents they stand for.

    With ``cells`` and ``probe`` the search is approximate (:func:`knn_cells`), with ``quantiser`` through codes.
    Hits without a document are left out, or kept with nulls with
    ``how="left"``. Spark broadcasts the hits when they turn out small; else a
    document near to many queries has its partition split.
    """
    hits = _search(queries, index, k, **options)
    wanted = docs.select(F.col(doc_id).alias("id"), *[c for c in columns if c not in ("id", doc_id)])
    return skew_join(hits, wanted, ["id"], how).select("query_id", "rank", "score", *columns)


def assemble_context(
    hits: DataFrame,
    questions: DataFrame,
    template: str = "{question}\n\n{context}",
    query_id: str = "query_id",
    question: str = "question",
    content: str = "content",
    url: str | None = None,
) -> DataFrame:
    """Prompt per query from its hits in rank order; ``sources`` lists distinct addresses.

    A query has at most k hits, so the collected lists are short.
    """
    lists = [F.sort_array(F.collect_list(F.struct("rank", content))).alias("__hits")]
    if url:
        lists.append(F.sort_array(F.collect_set(url)).alias("sources"))
    grouped = hits.groupBy(query_id).agg(*lists)
    context = F.array_join(F.transform("__hits", lambda h: h[content]), "\n\n")
    joined = questions.join(grouped.withColumn("context", F.coalesce(context, F.lit(""))).drop("__hits"), query_id, "left")
    return joined.withColumn("context", F.coalesce("context", F.lit(""))).withColumn(
        "prompt", render_prompt(template, question=F.col(question), context=F.coalesce("context", F.lit("")))
    )
