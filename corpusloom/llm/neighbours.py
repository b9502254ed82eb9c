"""Nearest neighbours by multi-index hashing: learned rotated binary codes, probed by substring, reranked on the vectors.

A rotation learned on a bounded sample (iterative quantisation: the rotation of
the principal axes that brings vectors nearest to the corners of a cube) turns
each vector into a code of up to 64 bits, one sign each. Codes are split into
substrings of one byte. A code within R bits of a query's differs by at most
R // substrings bits in one substring at least (pigeonhole; the remainder
tightens the later ones), so probing the lists of every substring's near values
retrieves every code within R. What it retrieves is reranked by exact distance.

R is calibrated: a bounded number of probes is compared with all vectors, and R
is the least radius that holds ``recall`` of their true neighbours. A query
that meets fewer than k vectors within R in a shard widens its radius there, so
every query gets k neighbours if there are so many.

Spark deals equal vectors together and keeps the k + 1 smallest ids of each
(another copy can be in no list), then deals vectors into shards of bounded
bytes by hash and queries into blocks; a task indexes one shard and answers one
block of queries.

Defined cases: rows without id, and vectors that are null, empty, zero, hold
null or non-finite components or have another length than most (ties: the
shorter) take no part. Rows of one id are one candidate, as near as the nearest
of its vectors, and never a candidate for that id. Equal distances go by id.
No vectors or no queries: no rows. Columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.skew import first_per_key

# Vectors that the rotation is learned on, and their bytes; probes that calibrate the radius.
SAMPLE_ROWS = 16_384
SAMPLE_BYTES = 1 << 25
PROBES = 192
ROUNDS = 25
MOST_BITS = 64
# Bytes of vectors in a shard and in a block of queries; shards that small tables are dealt into.
SHARD_BYTES = 1 << 24
LEAST_SHARDS = 32
# Share of true neighbours that the calibrated radius holds.
RECALL = 0.97


@dataclass(frozen=True)
class Codes:
    """Mean and rotation: bit j of a vector's code is the sign of its j-th rotated coordinate."""

    mean: np.ndarray
    rotation: np.ndarray
    radius: int = 0

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]

    @property
    def substrings(self) -> int:
        return -(-self.bits // 8)

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of eight bytes, unused bits zero."""
        packed = np.packbits((vectors - self.mean) @ self.rotation > 0, axis=1)
        return np.pad(packed, ((0, 0), (0, MOST_BITS // 8 - packed.shape[1])))


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hamming distances of rows of eight bytes to one of them."""
    return np.bitwise_count(codes.view(np.uint64)[:, 0] ^ code.view(np.uint64)[0])


def learn_rotation(sample: np.ndarray, bits: int = MOST_BITS, seed: int = 42) -> Codes:
    """Iterative quantisation over the principal axes of ``sample``."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    axes = vectors[:, ::-1][:, : min(bits, MOST_BITS, sample.shape[1])]
    projected = centred @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))
    for _ in range(ROUNDS):
        corners = np.where(projected @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(corners.T @ projected)
        turn = (left @ right).T
    return Codes(mean, axes @ turn)


class SubstringIndex:
    """For each byte of the codes, its rows in the order of that byte's values."""

    def __init__(self, codes: np.ndarray, substrings: int) -> None:
        self.codes, self.substrings = codes, substrings
        self.rows = [np.argsort(codes[:, j], kind="stable") for j in range(substrings)]
        self.starts = [np.searchsorted(codes[r, j], np.arange(257)) for j, r in enumerate(self.rows)]
        self.values = np.arange(256, dtype=np.uint8)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes differ from ``code`` in at most ``radius`` bits: every one of them, and no other."""
        most, rest = divmod(radius, self.substrings)
        met = np.zeros(len(self.codes), bool)
        for j in range(self.substrings):
            allowed = most if j <= rest else most - 1
            if allowed < 0:
                break
            near = np.flatnonzero(np.bitwise_count(self.values ^ code[j]) <= allowed)
            first, after = self.starts[j][near], self.starts[j][near + 1]
            sizes = after - first
            skipped = np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
            met[self.rows[j][skipped + np.arange(len(skipped))]] = True
        rows = np.flatnonzero(met)
        return rows[distances(self.codes[rows], code) <= radius]


def euclidean(vectors: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(vectors - vector).sum(axis=1))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _nearest(scores: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[float, int]]:
    """First ``k`` different ids by score, then id."""
    if len(scores) > 4 * k:
        bound = np.partition(scores, k - 1)[k - 1]
        if (scores <= bound).sum() >= k and len(np.unique(ids[scores <= bound])) >= k:
            ids, scores = ids[scores <= bound], scores[scores <= bound]
    seen: set[int] = set()
    for i in np.lexsort((ids, scores)).tolist():
        if (one := int(ids[i])) not in seen:
            seen.add(one)
            yield float(scores[i]), one
            if len(seen) == k:
                return


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id`` (long) and ``vector`` (doubles) of the rows that take part."""
    value = F.col("vector")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & value.isNotNull()).filter(~bad & F.exists(value, lambda x: x != 0))
    sizes = rows.groupBy(F.size(value).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size(value) == (sizes[0]["n"] if sizes else 0))


def fit(rows: DataFrame, total: int, dim: int, k: int, recall: float = RECALL, bits: int = MOST_BITS) -> Codes:
    """Codes learned on at most ``SAMPLE_ROWS`` of ``rows`` (id, vector), their radius calibrated against all rows."""
    wanted = max(2, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
    drawn = F.shiftrightunsigned(F.xxhash64("vector", F.lit(3)), 12)
    share = min(1.0, 1.1 * wanted / total)
    taken = rows.filter(drawn <= int(share * 2**52)).select(drawn.alias("d"), "vector").limit(2 * wanted).toArrow()
    sample = _matrix(taken.column("vector"))[np.argsort(taken.column("d").to_numpy(), kind="stable")[:wanted]]
    if not len(sample):
        sample = _matrix(rows.select("vector").limit(wanted).toArrow().column("vector"))
    codes = learn_rotation(sample, bits)
    found = _true_neighbours(rows, sample[:: max(1, len(sample) // PROBES)][:PROBES], codes, k)
    counts = {r["bits"]: r["count"] for r in found.groupBy("bits").count().collect()}
    needed, radius = recall * sum(counts.values()), 0
    while sum(n for d, n in counts.items() if d <= radius) < needed:
        radius += 1
    return Codes(codes.mean, codes.rotation, radius)


def _true_neighbours(rows: DataFrame, probes: np.ndarray, codes: Codes, k: int) -> DataFrame:
    """Code distance of the k vectors nearest to each probe, vectors equal to it left out."""
    probe_codes = codes.encode(probes)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = np.full((len(probes), k), np.inf)
        bits = np.zeros((len(probes), k), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                vectors = _matrix(batch.column(0).slice(start, 1024))
                hashed = codes.encode(vectors)
                for p, probe in enumerate(probes):
                    s = euclidean(vectors, probe)
                    s[s == 0] = np.inf
                    near = np.flatnonzero(s < scores[p].max())
                    both = np.concatenate([scores[p], s[near]])
                    order = np.argsort(both, kind="stable")[:k]
                    scores[p] = both[order]
                    bits[p] = np.concatenate([bits[p], distances(hashed[near], probe_codes[p])])[order]
        kept = np.isfinite(scores)
        where = np.nonzero(kept)[0]
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(scores[kept]), pa.array(bits[kept])], names=["probe", "score", "bits"])

    found = rows.select("vector").mapInArrow(compare, "probe long, score double, bits long")
    return first_per_key(found, ["probe"], ["score", "bits"], k)


def nearest(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    is_query: Column | None = None,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    recall: float = RECALL,
    codes: Codes | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for every query, all others its candidates.

    Queries are the rows of ``queries``, by default those of ``vectors`` for
    which ``is_query`` holds. ``codes`` from an earlier ``fit`` may be given.
    """
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, vec_id, vector)
    asked = usable(queries, vec_id, vector) if queries is not None else usable(vectors.filter(is_query), vec_id, vector)
    dims = rows.select(F.size("vector").alias("dim")).limit(1).collect()
    if not dims:
        return spark.createDataFrame([], result)
    dim = dims[0]["dim"]
    asked = asked.filter(F.size("vector") == dim)
    n_rows, n_asked = rows.count(), asked.count()
    codes = codes or fit(rows, n_rows, dim, k, recall)
    held = max(1, SHARD_BYTES // (8 * dim))
    shards, blocks = max(LEAST_SHARDS, -(-n_rows // held)), max(1, -(-n_asked // held))

    copies = first_per_key(rows.withColumn("h", F.xxhash64("vector")), ["h", "vector"], ["id"], k + 1)
    index = (
        copies.groupBy("h", "vector")
        .agg(F.collect_list("id").alias("ids"))
        .select("vector", "ids", F.pmod("h", F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    )
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    dealt = asked.select("id", "vector", block, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))

    def answer(members: pa.Table, questions: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if members.num_rows and questions.num_rows:
            base = _matrix(members.column("vector"))
            lists = members.column("ids").combine_chunks()
            ids, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            first = np.cumsum(sizes) - sizes
            table = SubstringIndex(codes.encode(base), codes.substrings)
            asked_for, wanted = questions.column("id").to_pylist(), _matrix(questions.column("vector"))
            for query, vector, code in zip(asked_for, wanted, codes.encode(wanted), strict=True):
                radius = codes.radius
                while True:
                    hit = table.within(code, radius)
                    if len(hit) > k or radius >= codes.bits:
                        break
                    radius += 2
                own = sizes[hit]
                at = np.repeat(first[hit] - (np.cumsum(own) - own), own) + np.arange(own.sum())
                scores, names = np.repeat(euclidean(base[hit], vector), own), ids[at]
                other = names != query
                found.extend((query, name, score) for score, name in _nearest(scores[other], names[other], k))
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    hits = index.groupBy("block", "shard").cogroup(dealt.groupBy("block", "shard")).applyInArrow(answer, "query_id long, vec_id long, score double")
    best = hits.repartition("query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return first_per_key(best, ["query_id"], ["score", "vec_id"], k, "rank").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
