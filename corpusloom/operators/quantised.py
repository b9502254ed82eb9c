"""Search in quantised cells: residual codes are scanned, candidates re-ranked on full vectors.

A quantiser fitted on a bounded sample deals vectors into cells and writes what
is left of a vector beyond its cell's center as one byte per part (product
quantisation). A task looks the levels of a block of codes up once and compares
all of its queries with them in one matrix product. The index keeps the distance ``error`` between a vector and
its code, so by the triangle inequality the true distance lies within ``error``
of the code's, and a cell holds nothing nearer than the distance of its center
less its radius.

Two ways to search follow. By bounds (``rerank=None``) the result is exact:
a first pass over each query's nearest cells gives a distance that k vectors
are known to keep; cells and codes that cannot come below it are left out, all
others are re-ranked. With ``rerank=n`` the n nearest codes of ``probe`` cells
are re-ranked, whatever the bounds say. Only re-ranking reads full vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.functions.vectors import as_matrix, scale_rows, unit_rows
from corpusloom.operators.retrieval import BLOCK_BYTES, DECIMALS, RESULT_BYTES, RESULT_ROW
from corpusloom.plans.skew import first_per_key, skew_join
from corpusloom.plans.workspace import materialize

# Vectors that a quantiser is fitted on, at most.
SAMPLE_ROWS = 16_384
LEVELS = 256
# Bytes of the distances that a task holds at once.
SCAN_BYTES = 8 * 1024 * 1024
# Distances are sums of rounded numbers: bounds are this much wider.
SLACK = 1e-6


@dataclass(frozen=True)
class Quantiser:
    """Cell centers, and per part the columns it covers and its levels; ``unit`` vectors are scaled to length one."""

    centers: np.ndarray
    columns: list[np.ndarray]
    books: list[np.ndarray]
    unit: bool

    def scaled(self, vectors: np.ndarray) -> np.ndarray:
        return unit_rows(vectors) if self.unit else vectors

    def nearest_centers(self, vectors: np.ndarray) -> np.ndarray:
        return _nearest(vectors, self.centers)

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cell, code, distance to the code and distance to the center of each (scaled) vector."""
        cells = self.nearest_centers(vectors)
        rest = vectors - self.centers[cells]
        codes = np.stack([_nearest(rest[:, c], book) for c, book in zip(self.columns, self.books, strict=True)], axis=1)
        gap = np.zeros(len(vectors))
        for n, (c, book) in enumerate(zip(self.columns, self.books, strict=True)):
            gap += np.square(rest[:, c] - book[codes[:, n]]).sum(axis=1)
        return cells, codes.astype(np.uint8), np.sqrt(gap) + SLACK, np.sqrt(np.square(rest).sum(axis=1)) + SLACK

    def decode(self, cell: int, codes: np.ndarray) -> np.ndarray:
        """What the codes of one cell stand for."""
        out = np.tile(self.centers[cell], (len(codes), 1))
        for n, (c, book) in enumerate(zip(self.columns, self.books, strict=True)):
            out[:, c] += book[codes[:, n]]
        return out


def _nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    if centers.shape[1] == 1 and len(centers) > 1:
        # On a line the levels stand in order, and borders lie half way between them.
        order = np.argsort(centers[:, 0], kind="stable")
        levels = centers[order, 0]
        return order[np.searchsorted((levels[1:] + levels[:-1]) / 2, rows[:, 0], side="right")]
    out, lengths = np.empty(len(rows), np.int64), np.square(centers).sum(axis=1)
    step = max(1, SCAN_BYTES // (8 * len(centers)))
    for start in range(0, len(rows), step):
        out[start : start + step] = np.argmin(lengths - 2 * rows[start : start + step] @ centers.T, axis=1)
    return out


def _means(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Lloyd's k-means; a center that loses all rows starts again from a random one."""
    rows = np.unique(rows, axis=0) if len(rows) <= k else rows
    if len(rows) <= k:
        return rows
    if rows.shape[1] == 1:
        centers = np.quantile(rows, (np.arange(k) + 0.5) / k, axis=0)
    else:
        centers = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        own = _nearest(rows, centers)
        counts = np.bincount(own, minlength=k)
        sums = np.stack([np.bincount(own, weights=rows[:, c], minlength=k) for c in range(rows.shape[1])], axis=1)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], rows[rng.choice(len(rows), k)])
    return centers


def fit_quantiser(
    index: DataFrame,
    cells: int,
    parts: int,
    metric: str = "cosine",
    vector: str = "embedding",
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 7,
) -> Quantiser:
    """Centers and levels from at most ``sample_rows`` vectors, picked by hash; the sample is all that the driver holds."""
    if metric not in ("cosine", "euclidean"):
        raise ValueError("codes know cosine and euclidean distances")
    there = index.filter(F.col(vector).isNotNull())
    share = min(1.0, 1.2 * sample_rows / max(1, there.count()))
    drawn = there.filter(F.pmod(F.xxhash64(vector, F.lit(seed)), F.lit(1 << 30)) <= int(share * (1 << 30)))
    sample = as_matrix(drawn.select(vector).limit(sample_rows).toArrow().column(0))
    if not len(sample):
        raise ValueError("no vectors to fit a quantiser on")
    # In an order of their own, so that the same rows give the same quantiser however they are stored.
    sample = sample[np.lexsort(sample.T)]
    sample = unit_rows(sample) if metric == "cosine" else sample
    rng = np.random.default_rng(seed)
    centers = _means(sample, cells, rng)
    rest = sample - centers[_nearest(sample, centers)]
    columns = np.array_split(np.arange(sample.shape[1]), min(parts, sample.shape[1]))
    return Quantiser(centers, columns, [_means(rest[:, c], LEVELS, rng) for c in columns], metric == "cosine")


def encode_index(index: DataFrame, quantiser: Quantiser, id: str = "id", vector: str = "embedding") -> DataFrame:
    """``id, cell, code, error, reach``: what a search scans; rows without a vector are left out."""

    @F.arrow_udf("struct<cell:int,code:binary,error:double,reach:double>")
    def encoded(vectors: pa.Array) -> pa.Array:
        x = as_matrix(vectors)
        if not len(x):
            return pa.array([], pa.struct([("cell", pa.int32()), ("code", pa.binary()), ("error", pa.float64()), ("reach", pa.float64())]))
        cells, codes, error, reach = quantiser.encode(quantiser.scaled(x))
        arrays = [pa.array(cells, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(reach)]
        return pa.StructArray.from_arrays(arrays, ["cell", "code", "error", "reach"])

    there = index.filter(F.col(vector).isNotNull()).select(F.col(id).alias("id"), encoded.asNondeterministic()(F.col(vector)).alias("e"))
    return there.select("id", "e.*")


def _probed(quantiser: Quantiser, first: int, radii: np.ndarray | None = None):
    """Arrow UDF (vector, bound) -> cells: the ``first`` nearest, or with ``radii`` all further ones that may hold something within bound."""

    @F.arrow_udf("array<int>")
    def cells(vectors: pa.Array, bounds: pa.Array) -> pa.Array:
        x = quantiser.scaled(as_matrix(vectors))
        if not len(x):
            return pa.array([], pa.list_(pa.int32()))
        far = np.sqrt(np.maximum(np.square(quantiser.centers).sum(axis=1) - 2 * x @ quantiser.centers.T + np.square(x).sum(axis=1)[:, None], 0))
        order = np.argsort(far, axis=1, kind="stable")
        if radii is None:
            return pa.array(order[:, :first].tolist(), pa.list_(pa.int32()))
        open_ = far - radii[None, :] <= bounds.to_numpy(zero_copy_only=False)[:, None] + 1e-6
        np.put_along_axis(open_, order[:, :first], False, axis=1)
        return pa.array([np.flatnonzero(row).tolist() for row in open_], pa.list_(pa.int32()))

    return cells.asNondeterministic()


def _scan(quantiser: Quantiser, k: int, rerank: int | None, exclude_self: bool, schema: pa.Schema):
    """Candidates of a block of queries in a block of one cell's codes."""

    def run(queries: pa.Table, codes: pa.Table) -> pa.Table:
        if queries.num_rows == 0 or codes.num_rows == 0:
            return schema.empty_table()
        codes = codes.sort_by("id")
        x = np.frombuffer(b"".join(codes.column("code").to_pylist()), np.uint8).reshape(codes.num_rows, -1)
        error = codes.column("error").to_numpy()
        known = quantiser.decode(codes.column("cell")[0].as_py(), x)
        lengths = np.square(known).sum(axis=1)
        q = as_matrix(queries.column("q_vector"))
        q = scale_rows(q) if quantiser.unit else q
        bound = queries.column("bound").to_numpy()
        q_ids, x_ids = queries.column("query_id"), codes.column("id")
        column_of = {v: n for n, v in enumerate(x_ids.to_pylist())} if exclude_self else {}
        rows, cols, low, high = [], [], [], []
        step = max(1, SCAN_BYTES // (8 * len(x)))
        for start in range(0, len(q), step):
            part = q[start : start + step]
            far = np.sqrt(np.maximum(lengths - 2 * part @ known.T + np.square(part).sum(axis=1)[:, None], 0))
            for n, query in enumerate(q_ids[start : start + step].to_pylist() if exclude_self else []):
                if (own := column_of.get(query)) is not None:
                    far[n, own] = np.inf
            there = np.isfinite(far)
            take = min(rerank or k, len(x))
            if rerank is None:
                # What k codes keep in any case bounds this block; what k vectors elsewhere keep bounds it as well.
                reached = np.partition(far + error, take - 1, axis=1)[:, take - 1] if take == k else np.full(len(far), np.inf)
                chosen = far - error <= np.minimum(reached, bound[start : start + step])[:, None]
            else:
                chosen = far <= np.partition(far, take - 1, axis=1)[:, [take - 1]]
            r, c = np.nonzero(chosen & there)
            rows.append(r + start)
            cols.append(c)
            low.append(far[r, c] - error[c])
            high.append(far[r, c] + error[c])
        r, c = pa.array(np.concatenate(rows)), pa.array(np.concatenate(cols))
        return pa.table([q_ids.take(r), x_ids.take(c), pa.array(np.concatenate(low)), pa.array(np.concatenate(high))], schema=schema)

    return run


def _candidates(queries: DataFrame, codes: DataFrame, quantiser: Quantiser, k: int, rerank: int | None, exclude_self: bool, block_bytes: int) -> DataFrame:
    """``query_id, id, low, high`` of the queries' ``cell`` rows against the codes of those cells."""
    q_type, i_type = queries.schema["query_id"].dataType, codes.schema["id"].dataType
    schema = pa.schema([("query_id", to_arrow_type(q_type)), ("id", to_arrow_type(i_type)), ("low", pa.float64()), ("high", pa.float64())])
    held = max(1, block_bytes // (8 * quantiser.centers.shape[1]))
    # A block of queries is bounded by what it gives back as well.
    asked = max(1, min(held, RESULT_BYTES // (RESULT_ROW * (rerank or k))))

    # One row per cell, as many as the quantiser has centers. Cells that hold much are cut into blocks on both sides.
    def parts(df: DataFrame, name: str, most: int) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).cast("int").alias(name))

    sizes = F.broadcast(parts(queries, "q_parts", asked).join(parts(codes, "i_parts", held), "cell"))

    def block(id: str, count: str) -> Column:
        return F.pmod(F.xxhash64(id), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    q = queries.join(sizes, "cell").withColumn("qb", block("query_id", "q_parts")).withColumn("ib", every("i_parts"))
    i = codes.select("id", "cell", "code", "error").join(sizes, "cell").withColumn("ib", block("id", "i_parts")).withColumn("qb", every("q_parts"))
    keys = ["cell", "qb", "ib"]
    q, i = q.drop("q_parts", "i_parts"), i.drop("q_parts", "i_parts")
    ddl = f"query_id {q_type.simpleString()}, id {i_type.simpleString()}, low double, high double"
    return q.groupBy(*keys).cogroup(i.groupBy(*keys)).applyInArrow(_scan(quantiser, k, rerank, exclude_self, schema), ddl)


def candidates(
    queries: DataFrame,
    codes: DataFrame,
    quantiser: Quantiser,
    k: int,
    probe: int,
    rerank: int | None = None,
    exclude_self: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``query_id, id`` pairs to compare on full vectors (``queries``: query_id, q_vector)."""
    probes = min(probe, len(quantiser.centers))
    start = queries.withColumn("bound", F.lit(float("inf")))
    near = start.withColumn("cell", F.explode(_probed(quantiser, probes)(F.col("q_vector"), F.col("bound"))))
    found = materialize(_candidates(near, codes, quantiser, k, rerank, exclude_self, block_bytes), "code-candidates")
    if rerank is not None:
        return first_per_key(found, ["query_id"], [F.col("low") + F.col("high"), F.col("id")], rerank).select("query_id", "id")
    bounds = _kept_by(found, k)
    if probes < len(quantiser.centers):
        # The radius of a cell, one number per center.
        radii = np.full(len(quantiser.centers), -np.inf)
        for row in codes.groupBy("cell").agg(F.max("reach").alias("reach")).collect():
            radii[row["cell"]] = row["reach"]
        told = queries.join(bounds, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
        rest = told.withColumn("cell", F.explode(_probed(quantiser, probes, radii)(F.col("q_vector"), F.col("bound"))))
        more = _candidates(rest, codes, quantiser, k, rerank, exclude_self, block_bytes)
        found = materialize(found.unionByName(more), "code-candidates")
        bounds = _kept_by(found, k)
    kept = found.join(bounds, "query_id", "left").filter(F.col("bound").isNull() | (F.col("low") <= F.col("bound")))
    return kept.select("query_id", "id")


def _kept_by(found: DataFrame, k: int) -> DataFrame:
    """``query_id, bound``: the distance that k vectors keep; queries that met fewer have none."""
    ranked = first_per_key(found, ["query_id"], ["high", "id"], k, "rank")
    return ranked.filter(F.col("rank") == k).select("query_id", (F.col("high") + 1e-6).alias("bound"))


def _pair_scores(quantiser: Quantiser):
    @F.arrow_udf("double")
    def scores(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = quantiser.scaled(as_matrix(a)), quantiser.scaled(as_matrix(b))
        own = (x * y).sum(axis=1) if quantiser.unit else -np.sqrt(np.square(x - y).sum(axis=1))
        return pa.array(np.round(own, DECIMALS) + 0.0)

    return scores.asNondeterministic()


def search_quantised(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    quantiser: Quantiser,
    codes: DataFrame | None = None,
    probe: int = 4,
    rerank: int | None = None,
    query_id: str = "query_id",
    id: str = "id",
    vector: str = "embedding",
    exclude_self: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``query_id, id, score, rank``: nearest neighbours through codes; scores are cosines or negative distances.

    Exact for ``rerank=None``: cells beyond the first ``probe`` are scanned
    where they may still hold a neighbour. Store ``codes``
    (:func:`encode_index`) beside the index to encode once. Ids are unique.
    """
    q = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("q_vector")).filter("q_vector is not null")
    i = index.select(F.col(id).alias("id"), F.col(vector).alias("i_vector")).filter("i_vector is not null")
    codes = encode_index(index, quantiser, id, vector) if codes is None else codes
    pairs = candidates(q, codes, quantiser, k, probe, rerank, exclude_self, block_bytes)
    # A vector near to many queries has its partition split, and so has a query with many candidates.
    full = skew_join(skew_join(pairs, i, ["id"], "inner"), q, ["query_id"], "inner")
    scored = full.select("query_id", "id", _pair_scores(quantiser)("q_vector", "i_vector").alias("score"))
    return first_per_key(scored, ["query_id"], [F.desc("score"), F.col("id")], k, "rank")
