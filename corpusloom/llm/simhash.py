"""SimHash near-duplicates: exact pairs of fingerprints within a Hamming distance, found with vantage-point trees.

A tree fitted on a bounded sample of fingerprints cuts the space into shards:
a node keeps a vantage fingerprint and a radius, members within the radius go
left, others right. A member on the right that lies within the search distance
of the boundary is also sent left, which by the triangle inequality puts every
pair within that distance into one shard at least. In a shard the same
partitioning goes on locally until blocks are small enough to compare. Shards
report components as stars, never pairs; Spark joins them into components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.texts import SLICE_BYTES, map_texts, raw_texts
from corpusloom.plans.workspace import materialize

# Fixed values of the contract.
SHINGLE_WORDS = 3
HASH_SEED = 42
MOST_BITS = 2

# Fingerprints that the tree is fitted on, and that a shard should hold.
SAMPLE = 8192
SHARD_SIZE = 4096
# Members that are compared one with another; larger sets are split as long as that saves work.
BLOCK = 512
# Comparisons held at once; in a dense set every one of them may be a link.
COMPARED = 1 << 19
VANTAGE_TRIES = 8


def fingerprint_of(text: bytes | None) -> list[int]:
    """Hashes of the text's shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = [] if text is None else text.lower().split()
    if len(words) < SHINGLE_WORDS:
        return [xxh64_intdigest(b" ".join(words), HASH_SEED)] if words else []
    body = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - SHINGLE_WORDS + 1].tolist()
    ends = ends[SHINGLE_WORDS - 1 :].tolist()
    return [xxh64_intdigest(body[a:b], HASH_SEED) for a, b in zip(starts, ends, strict=True)]


def fingerprint_array(texts: list[bytes | None]) -> np.ndarray:
    """One signed 64-bit fingerprint per text: the bits set in over half of its hashes; 0 without words.

    A shingle takes over a hundred bytes while its bits are counted, so texts
    are taken in runs of about ``SLICE_BYTES``.
    """
    out, first, held = np.zeros(len(texts), ">u8"), 0, 0
    for n, text in enumerate(texts):
        held += len(text or b"")
        if held >= SLICE_BYTES or n + 1 == len(texts):
            out[first : n + 1] = majority_bits([fingerprint_of(t) for t in texts[first : n + 1]])
            first, held = n + 1, 0
    return out.astype(np.uint64).view(np.int64)


def majority_bits(hashes: list[list[int]]) -> np.ndarray:
    counts = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), ">u8")
    full = np.flatnonzero(counts)
    if len(full):
        flat = np.array([h for i in full for h in hashes[i]], ">u8")
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1)
        starts = np.append(0, np.cumsum(counts[full]))[:-1]
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * sums > counts[full, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, fingerprint`` (signed long) of every whole text, one row per row; null and empty texts give 0."""
    kind = docs.schema[id_column].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            prints = pa.array(fingerprint_array(raw_texts(batch.column(1))))
            return pa.RecordBatch.from_arrays([batch.column(0), prints], [id_column, "fingerprint"])

        return work

    return map_texts(docs, [id_column, text_column], text_column, make, f"`{id_column}` {kind}, fingerprint bigint")


def fingerprint_column(text: Column) -> Column:
    @F.arrow_udf("bigint")
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprint_array(raw_texts(texts)))

    return prints(text)


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_bits: int = MOST_BITS,
    sample: int = SAMPLE,
    shard_size: int = SHARD_SIZE,
) -> DataFrame:
    """``id, fingerprint, class, component_id``: documents whose fingerprints are linked, one row per row of ``docs``.

    Fingerprints at ``most_bits`` or fewer differing bits are linked, classes
    are what links reach. ``class`` is a fingerprint of the class,
    ``component_id`` its smallest id (null if all ids are null). Texts without
    words share fingerprint 0 and are linked like any others. Repeated ids and
    rows are rows like others. Equal fingerprints are met once, with their
    smallest id, before anything is compared.
    """
    prints = materialize(fingerprints(docs, id_column, text_column), "simhash")
    return linked_prints(prints, id_column, most_bits, sample, shard_size)


def linked_prints(
    prints: DataFrame, id_column: str, most_bits: int = MOST_BITS, sample: int = SAMPLE, shard_size: int = SHARD_SIZE
) -> DataFrame:
    """:func:`near_duplicates` of rows whose fingerprints (``id, fingerprint``) are written already."""
    distinct = materialize(prints.groupBy("fingerprint").agg(F.min(id_column).alias("least")), "simhash-distinct")
    stars = linked_stars(distinct.select("fingerprint"), most_bits, sample, shard_size)
    roots = components(stars)
    classes = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("class")
    )
    classes = materialize(classes, "simhash-classes")
    smallest = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    named = materialize(classes.join(smallest, "class").drop("least"), "simhash-named")
    return prints.join(named, "fingerprint").select(id_column, "fingerprint", "class", "component_id")


def keep_first(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", among: DataFrame | None = None, **options
) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id, or one with a null id if there are only those.

    With ``among`` (``id, fingerprint`` of some rows of ``docs``) classes are those of these rows, and no others stay.
    """
    # Written before it is grouped: rows of one fingerprint could not be split up any more.
    if among is None:
        classed = near_duplicates(docs, id_column, text_column, **options)
    else:
        classed = linked_prints(materialize(among, "simhash"), id_column, **options)
    found = materialize(classed, "simhash-found")
    chosen = found.groupBy("class").agg(
        F.min(F.when(F.col(id_column).eqNullSafe(F.col("component_id")), F.struct(id_column, "fingerprint"))).alias("__first")
    )
    rows = found.groupBy(F.col(id_column).alias("__id"), F.col("fingerprint").alias("__print")).agg(F.count(F.lit(1)).alias("__rows"))
    kept = chosen.select("__first.*").withColumnsRenamed({id_column: "__id", "fingerprint": "__print"})
    same = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__print") == F.col("__p"))
    kept = materialize(rows.join(kept.withColumnsRenamed({"__id": "__i", "__print": "__p"}), same, "left_semi"), "simhash-kept")
    marked = docs.withColumn("__fp", fingerprint_column(F.col(text_column)))
    joined = marked.join(kept, (F.col("__fp") == F.col("__print")) & F.col(id_column).eqNullSafe(F.col("__id")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = joined.filter("__rows = 1").select(*columns)
    # Several rows of one id and fingerprint: one of them stays.
    several = joined.filter("__rows > 1")
    one = several.dropDuplicates(["__id", "__print"]).select(*columns)
    return single.unionByName(one)


# Vantage-point tree


@dataclass(frozen=True)
class Node:
    vantage: int
    radius: int
    left: Node | int
    right: Node | int


def distances(members: np.ndarray, vantage: int) -> np.ndarray:
    return np.bitwise_count(members ^ np.uint64(vantage))


def best_split(members: np.ndarray, most_bits: int, rng: np.random.Generator) -> tuple[int, int, float] | None:
    """Vantage, radius and the share of comparisons that remain; None where no split saves any."""
    best = None
    size = len(members)
    for vantage in rng.choice(members, min(VANTAGE_TRIES, size), replace=False).tolist():
        counts = np.bincount(distances(members, vantage), minlength=65 + most_bits)
        inside = np.cumsum(counts)
        left, right = inside[most_bits : 65 + most_bits], size - inside[:65]
        work = (left.astype(float) ** 2 + right.astype(float) ** 2) / size**2
        radius = int(np.argmin(work))
        if best is None or work[radius] < best[2]:
            best = (vantage, radius, float(work[radius]))
    return best if best and best[2] < 0.9 else None


def grow(members: np.ndarray, least: int, most_bits: int) -> tuple[Node | int, int]:
    """A tree over the sample whose leaves are shard numbers, and the number of shards."""
    rng, shards = np.random.default_rng(7), 0

    def node(part: np.ndarray) -> Node | int:
        nonlocal shards
        split = best_split(part, most_bits, rng) if len(part) > least else None
        if split is None:
            shards += 1
            return shards - 1
        vantage, radius, _ = split
        d = distances(part, vantage)
        return Node(vantage, radius, node(part[d <= radius + most_bits]), node(part[d > radius]))

    return node(members), shards


def route(tree: Node | int, members: np.ndarray, most_bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions) of all members: each goes to its own side, and left as well near the boundary."""
    pending = [(tree, np.arange(len(members)))]
    while pending:
        node, at = pending.pop()
        if isinstance(node, int):
            yield node, at
            continue
        d = distances(members[at], node.vantage)
        left, right = at[d <= node.radius + most_bits], at[d > node.radius]
        if len(left):
            pending.append((node.left, left))
        if len(right):
            pending.append((node.right, right))


def linked_stars(distinct: DataFrame, most_bits: int, sample: int, shard_size: int) -> DataFrame:
    """``node, root``: for every fingerprint with a smaller one in its shard's component, the smallest there."""
    total = distinct.count()
    rows = distinct.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(sample).collect()
    fitted = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    least = max(8, int(shard_size * len(fitted) / max(total, 1)))
    tree, _ = grow(fitted, least, most_bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = np.asarray(batch.column(0)).view(np.uint64)
            for shard, at in route(tree, members, most_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), shard, np.int32)), pa.array(members[at].view(np.int64))],
                    ["shard", "fingerprint"],
                )

    def link(table: pa.Table) -> pa.Table:
        members = np.unique(table["fingerprint"].to_numpy()).view(np.uint64)
        label = local_components(members, most_bits)
        linked = np.flatnonzero(label != np.arange(len(members)))
        signed = members.view(np.int64)
        return pa.table({"node": signed[linked], "root": signed[label[linked]]})

    dealt = distinct.mapInArrow(deal, "shard int, fingerprint bigint")
    stars = dealt.groupBy("shard").applyInArrow(link, "node bigint, root bigint")
    return materialize(stars, "simhash-stars")


def local_components(members: np.ndarray, most_bits: int) -> np.ndarray:
    """For each of the (distinct) members the first member of its component within this set."""
    rng = np.random.default_rng(7)
    ends_a, ends_b = [], []
    pending = [np.arange(len(members))]
    while pending:
        at = pending.pop()
        split = best_split(members[at], most_bits, rng) if len(at) > BLOCK else None
        if split is not None:
            d = distances(members[at], split[0])
            pending += [at[d <= split[1] + most_bits], at[d > split[1]]]
            continue
        a, b = close_pairs(members[at], most_bits)
        ends_a.append(at[a])
        ends_b.append(at[b])
    if not ends_a:
        return np.arange(len(members))
    return merge(np.concatenate(ends_a), np.concatenate(ends_b), len(members))


def close_pairs(members: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges of the components of a set that no further split helps with, in pieces of bounded size."""
    size = len(members)
    label = np.arange(size)
    step = max(1, COMPARED // max(size, 1))
    for first in range(0, size, step):
        close = np.bitwise_count(members[first : first + step, None] ^ members[None, :]) <= most_bits
        a, b = np.nonzero(close)
        keep = a + first != b
        if keep.any():
            known = np.flatnonzero(label != np.arange(size))
            label = merge(np.append(a[keep] + first, known), np.append(b[keep], label[known]), size)
    linked = np.flatnonzero(label != np.arange(size))
    return linked, label[linked]


def merge(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Smallest position of each position's component under the edges a-b."""
    label = np.arange(size)
    while True:
        x, y = label[a], label[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        apart = low != high
        if not apart.any():
            return label
        np.minimum.at(label, high[apart], low[apart])
        while not np.array_equal(further := label[label], label):
            label = further


# Components over all shards


def components(stars: DataFrame) -> DataFrame:
    """``node, root`` with one root per component, by alternating star joins over written tables.

    Neighbours are reduced to their minimum before they are joined back, and
    the edges of every round point from a node to a smaller one, so an edge
    table never outgrows the first.
    """
    edges = stars.filter("node <> root").select("node", F.col("root").alias("to"))
    edges = materialize(edges.distinct(), "simhash-edges")
    mark = _mark(edges)
    while True:
        edges = materialize(_star(edges, large=True), "simhash-large")
        edges = materialize(_star(edges, large=False), "simhash-small")
        now = _mark(edges)
        if now == mark:
            return edges.select("node", F.col("to").alias("root"))
        mark = now


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "to") % 1_000_003)).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        # Larger neighbours of a node go to the smallest of the node and its neighbours.
        both = edges.unionByName(edges.select(F.col("to").alias("node"), F.col("node").alias("to")))
        least = both.groupBy("node").agg(F.min("to").alias("m")).select("node", F.least("node", "m").alias("m"))
        moved = both.join(least, "node").filter("`to` > node").select(F.col("to").alias("node"), F.col("m").alias("to"))
    else:
        # A node and its smaller neighbours go to the smallest neighbour.
        least = edges.groupBy("node").agg(F.min("to").alias("m"))
        joined = edges.join(least, "node")
        moved = joined.select(F.explode(F.array("node", "to")).alias("node"), F.col("m").alias("to"))
    return moved.filter("node <> `to`").distinct()
