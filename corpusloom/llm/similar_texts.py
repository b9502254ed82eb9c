"""Texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Such texts differ in some ten of 64 SimHash bits, a radius at which vantage-point
trees prune nothing. Candidates therefore come from min-wise hashes in bands:
texts that agree in a band meet, a maximum spanning forest over their estimated
similarities picks fewer edges than members, and each picked edge is decided by
the exact similarity of the two shingle sets. That joins nearly all that belongs
together without pair lists. Estimates err and large buckets are cut for it, so
a second pass goes through every band's buckets whole: members that are not yet
in one class are compared by their shingle sets, all with all.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.simhash import components, fingerprint_array, keep_first
from corpusloom.llm.texts import map_texts, raw_texts
from corpusloom.plans.workspace import materialize

SHINGLE_WORDS = 5
LEAST = 0.8
# A pair of similarity 0.8 meets in one band at least with probability 1 - (1 - 0.8**5)**16 = 0.998.
BANDS, ROWS = 16, 5
# Edges whose estimated similarity (deviation 0.045 at 0.8) is lower are left to the second pass.
ESTIMATE = 0.65
# Members of a bucket that one task compares; larger buckets are cut into blocks.
BUCKET = 1024
# Shingles of a block in the second pass.
BLOCK_GRAMS = 1 << 21
# Members of a bucket whose pairs are written out.
PAIRED = 16


def shingle_hashes(text: bytes | None) -> tuple[int, np.ndarray]:
    """Hash of the word sequence (A-Z lower-cased) and the distinct 64-bit hashes of its shingles."""
    from xxhash import xxh64_intdigest

    words = [] if text is None else text.lower().split()
    body = b" ".join(words)
    whole = xxh64_intdigest(body)
    if len(words) <= SHINGLE_WORDS:
        return whole, np.array([whole] if words else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[: len(words) - SHINGLE_WORDS + 1].tolist()
    hashes = {xxh64_intdigest(body[a:b]) for a, b in zip(starts, ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)}
    return whole, np.fromiter(hashes, np.uint64, len(hashes))


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    size = BANDS * ROWS
    return rng.integers(1 << 62, size=size, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(1 << 62, size=size, dtype=np.uint64)


def minima(hashes: np.ndarray, odd: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """High halves of the least values of ``BANDS * ROWS`` multiply-shift functions, over pieces of bounded size."""
    least = np.full(len(odd), np.iinfo(np.uint64).max)
    for first in range(0, len(hashes), 4096):
        part = hashes[first : first + 4096, None] * odd + shift
        np.minimum(least, (part ^ (part >> np.uint64(29))).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketches(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id, node, minima, grams, fingerprint`` per row: word-sequence hash, min-wise hashes, distinct 32-bit shingle hashes, SimHash.

    Without words node, minima and grams are null.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        odd, shift = _multipliers()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nodes, lows, grams = [], [], []
            texts = raw_texts(batch.column(1))
            for text in texts:
                whole, hashes = shingle_hashes(text)
                there = len(hashes) > 0
                nodes.append(whole)
                lows.append(minima(hashes, odd, shift).tobytes() if there else None)
                grams.append(np.unique((hashes >> np.uint64(32)).astype(np.uint32)).view(np.int32) if there else None)
            node = pa.array(np.array(nodes, np.uint64).view(np.int64), mask=np.array([g is None for g in grams], bool))
            prints = pa.array(fingerprint_array(texts))
            columns = [batch.column(0), node, pa.array(lows, pa.binary()), pa.array(grams, pa.list_(pa.int32())), prints]
            return pa.RecordBatch.from_arrays(columns, ["id", "node", "minima", "grams", "fingerprint"])

        return work

    schema = f"id {kind}, node bigint, minima binary, grams array<int>, fingerprint bigint"
    return map_texts(docs, [id_column, text_column], text_column, make, schema)


def node_column(text: Column) -> Column:
    """The word-sequence hash of each text, null without words."""

    @F.arrow_udf("bigint")
    def nodes(texts: pa.Array) -> pa.Array:
        from xxhash import xxh64_intdigest

        words = [b" ".join((t or b"").lower().split()) for t in raw_texts(texts)]
        hashed = np.array([xxh64_intdigest(w) for w in words], np.uint64).view(np.int64)
        return pa.array(hashed, mask=np.array([not w for w in words], bool))

    return nodes(text)


def _counted(keyed: DataFrame) -> DataFrame:
    """``key, node, members, hub`` of the rows whose key is shared."""
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("hub")).filter("members > 1")
    return keyed.join(shared, "key")


def _every_band() -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))


def _slice_of(band: Column) -> Column:
    width = 4 * ROWS
    return F.substring(F.col("minima"), band * width + 1, F.lit(width))


def shared_bands(nodes: DataFrame) -> DataFrame:
    """``key, node, size, band, members, hub``: every node once per band in which others agree with it."""
    first = nodes.select("node", "size", "minima", _every_band().alias("band"))
    return _counted(first.select("node", "size", "band", F.xxhash64("band", _slice_of(F.col("band"))).alias("key")))


def buckets(found: DataFrame, nodes: DataFrame, most: int = BUCKET) -> DataFrame:
    """``bucket, node``: nodes that agree in a band, in groups of about ``most`` members.

    A larger bucket is refined by each of the other bands. What stays larger
    holds very many alike texts: it is dealt into blocks by hash, each of which
    also gets the bucket's smallest node, so that blocks stay connected. What
    the cuts part is compared by :func:`remaining_links`.
    """
    small = found.filter(F.col("members") <= most).select(F.col("key").alias("bucket"), "node")
    refined = (
        found.filter(F.col("members") > most)
        .join(nodes.select("node", "minima"), "node")
        .select("node", "key", F.col("band"), _every_band().alias("other"), "minima")
        .filter("band <> other")
        .select("node", F.xxhash64("key", "other", _slice_of(F.col("other"))).alias("key"))
    )
    again = materialize(_counted(refined), "similar-refined")
    blocks = F.ceil(F.col("members") / most)
    # One block where the bucket is small enough, else as many as its size asks for.
    dealt = again.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), blocks))
    own = dealt.select(F.xxhash64("key", "block").alias("bucket"), "node")
    hubs = dealt.filter(F.col("members") > most).select(F.xxhash64("key", "block").alias("bucket"), F.col("hub").alias("node"))
    return small.unionByName(own).unionByName(hubs.distinct())


def spanning_edges(lows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a maximum spanning forest over the share of equal minima, without those below ``ESTIMATE``."""
    size = len(lows)
    best, parent = np.zeros(size), np.zeros(size, np.int64)
    outside, at = np.ones(size, bool), 0
    ends = []
    for _ in range(size - 1):
        outside[at] = False
        share = (lows == lows[at]).mean(axis=1)
        nearer = outside & (share > best)
        best[nearer], parent[nearer] = share[nearer], at
        at = int(np.argmax(np.where(outside, best, -1.0)))
        if best[at] >= ESTIMATE:
            ends.append((at, int(parent[at])))
    pairs = np.array(ends, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def candidate_edges(found: DataFrame, nodes: DataFrame, most: int = BUCKET) -> DataFrame:
    """``node, root`` (root the smaller): fewer edges per bucket than it has members."""
    members = buckets(found, nodes, most).join(nodes.select("node", "minima"), "node")

    def link(table: pa.Table) -> pa.Table:
        ids, at = np.unique(table["node"].to_numpy(), return_index=True)
        raw = table["minima"].take(pa.array(at)).to_pylist()
        a, b = spanning_edges(np.frombuffer(b"".join(raw), np.uint32).reshape(len(ids), -1))
        return pa.table({"node": np.maximum(ids[a], ids[b]), "root": np.minimum(ids[a], ids[b])})

    return materialize(members.groupBy("bucket").applyInArrow(link, "node bigint, root bigint").distinct(), "similar-edges")


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def parted_buckets(found: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, node, size, label, rest, others, ..``: members of the buckets of :func:`shared_bands` that hold several classes.

    ``label`` is a node's class so far, ``rest`` says that it is not the
    bucket's largest one: each pair of different classes has a member of the
    rest. ``rests, rest_grams, members, grams`` are the bucket's sums.
    """
    labelled = found.select("key", "node", "size").join(roots.select("node", "root"), "node", "left")
    labelled = materialize(labelled.select("key", "node", "size", F.coalesce("root", "node").alias("label")), "similar-labelled")
    counts = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("held"))
    largest = F.max(F.struct("n", "held", "label"))
    sums = counts.groupBy("key").agg(largest.alias("top"), F.sum("n").alias("members"), F.sum("held").alias("grams"))
    parted = sums.filter(F.col("top.n") < F.col("members")).select(
        "key", F.col("top.label").alias("main"), "members", "grams",
        (F.col("members") - F.col("top.n")).alias("rests"), (F.col("grams") - F.col("top.held")).alias("rest_grams"),
    )
    return labelled.join(parted, "key").withColumn("rest", F.col("label") != F.col("main")).drop("main")


def remaining_links(found: DataFrame, roots: DataFrame, grams: DataFrame, most: int = BUCKET, paired: int = PAIRED) -> DataFrame:
    """``node, root``: links between different classes, from the members of all buckets compared with one another.

    Small buckets are written out as pairs, each met once. In others the blocks of
    the rest meet all blocks of the bucket, so a bucket of mostly one class costs
    what it holds and a task has two blocks at a time.
    """
    parted = materialize(parted_buckets(found, roots), "similar-parted")
    few, many = parted.filter(F.col("members") <= paired), parted.filter(F.col("members") > paired)
    one = few.select("key", "node", "size", "label")
    two = one.withColumnsRenamed({"node": "other", "size": "other_size", "label": "other_label"})
    apart = (F.col("node") > F.col("other")) & (F.col("label") != F.col("other_label"))
    near = F.least("size", "other_size") / F.greatest("size", "other_size") >= LEAST
    pairs = one.join(two, "key").filter(apart & near).select("node", "other", "label", "other_label").distinct()
    full = pairs.join(grams, "node").join(grams.select(F.col("node").alias("other"), F.col("grams").alias("others")), "other")
    alike = full.filter(jaccard(F.col("grams"), F.col("others")) >= LEAST).select("label", "other_label")
    linked = many_links(many, grams, most).unionByName(alike)
    return linked.select(F.greatest("label", "other_label").alias("node"), F.least("label", "other_label").alias("root")).distinct()


def many_links(parted: DataFrame, grams: DataFrame, most: int = BUCKET) -> DataFrame:
    """``label, other_label`` of the classes linked in the cells of each bucket: a block of the rest, a block of all."""

    def blocks(members: str, held: str) -> Column:
        return F.ceil(F.greatest(F.col(members) / most, F.col(held) / BLOCK_GRAMS)).cast("int")

    def block_of(count: str) -> Column:
        return F.pmod(F.xxhash64("node", F.lit("cell")), F.col(count)).cast("int")

    def numbers(count: str) -> Column:
        return F.sequence(F.lit(0), F.col(count) - 1)

    dealt = parted.withColumn("rows", blocks("rests", "rest_grams")).withColumn("columns", blocks("members", "grams"))
    dealt = dealt.withColumn("row", block_of("rows")).withColumn("column", block_of("columns"))
    # A member stands in its column, and one of the rest in its row as well.
    down = F.transform(
        numbers("rows"), lambda r: F.struct(r.alias("row"), F.col("column"), (F.col("rest") & (r == F.col("row"))).alias("seeks"), F.lit(True).alias("held"))
    )
    along = F.transform(
        F.filter(numbers("columns"), lambda c: F.col("rest") & (c != F.col("column"))),
        lambda c: F.struct(F.col("row"), c.alias("column"), F.lit(True).alias("seeks"), F.lit(False).alias("held")),
    )
    cells = dealt.select("key", "node", "label", F.inline(F.concat(down, along))).join(grams, "node")

    def link(table: pa.Table) -> pa.Table:
        sets, labels = table["grams"].combine_chunks(), table["label"].to_numpy()
        seeks, held = (np.flatnonzero(table[c].to_numpy()) for c in ("seeks", "held"))
        a, b = linked_labels(sets.flatten().to_numpy(), sets.value_lengths().to_numpy(), labels, seeks, held)
        return pa.table({"label": pa.array(a, pa.int64()), "other_label": pa.array(b, pa.int64())})

    return cells.groupBy("key", "row", "column").applyInArrow(link, "label bigint, other_label bigint")


def linked_labels(flat: np.ndarray, sizes: np.ndarray, labels: np.ndarray, seeks: np.ndarray, held: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges that join the labels of ``seeks`` and ``held`` members (positions) with a similarity of ``LEAST`` or more.

    ``flat`` holds the members' sets one after another. Of links between labels that others join already none is given.
    """
    ends = np.cumsum(sizes)
    owners = np.repeat(np.arange(len(held)), sizes[held])
    tokens = np.concatenate([flat[ends[m] - sizes[m] : ends[m]] for m in held]) if len(held) else flat[:0]
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    parent: dict[int, int] = {}

    def top(label: int) -> int:
        while (up := parent.get(label, label)) != label:
            parent[label] = label = parent.get(up, up)
        return label

    edges: list[tuple[int, int]] = []
    for m in seeks.tolist():
        own = flat[ends[m] - sizes[m] : ends[m]]
        first, last = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
        runs = last - first
        # Places of all tokens that the member shares, run by run.
        places = np.repeat(first - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
        common = np.bincount(owners[places], minlength=len(held))
        alike = common / (len(own) + sizes[held] - common) >= LEAST
        for other in np.unique(labels[held[alike]]).tolist():
            a, b = top(int(labels[m])), top(other)
            if a != b:
                parent[a] = b
                edges.append((int(labels[m]), other))
    return [a for a, _ in edges], [b for _, b in edges]


def similar_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", most: int = BUCKET, paired: int = PAIRED) -> DataFrame:
    """:func:`classes_of` the texts of ``docs``."""
    return classes_of(materialize(sketches(docs, id_column, text_column), "similar-sketches"), most, paired)


def classes_of(sketched: DataFrame, most: int = BUCKET, paired: int = PAIRED) -> DataFrame:
    """``node, class``: one row per distinct word sequence that has a similar one; ``class`` is the node that stays.

    Two texts are linked when their sets of five-word shingles (a shorter text
    is one shingle) have a similarity of 0.8 or more; classes are what links
    reach, and the node of the smallest id stays (null ids come last, ties go
    to the smaller node). Texts without words are linked to nothing. All texts
    that agree in a band are compared or in one class; none is left out for a
    bucket's size or an estimate.
    """
    sketched = sketched.filter("node is not null")
    firsts = sketched.groupBy("node").agg(F.min("id").alias("least"), F.first("minima").alias("minima"), F.first(F.size("grams")).alias("size"))
    nodes = materialize(firsts, "similar-nodes")
    found = materialize(shared_bands(nodes), "similar-bands")
    edges = candidate_edges(found, nodes, most)
    # Equal word sequences have equal sets: one of each is needed.
    met = found.select("node").distinct()
    grams = sketched.select("node", "grams").join(met, "node", "left_semi").groupBy("node").agg(F.first("grams").alias("grams"))
    grams = materialize(grams, "similar-grams")
    pairs = edges.join(grams, "node").join(grams.select(F.col("node").alias("root"), F.col("grams").alias("others")), "root")
    links = materialize(pairs.filter(jaccard(F.col("grams"), F.col("others")) >= LEAST).select("node", "root"), "similar-links")
    roots = components(links)
    more = materialize(remaining_links(found, roots, grams, most, paired), "similar-more")
    if not more.isEmpty():
        # Labels are roots or single nodes: their links join whole classes.
        roots = components(roots.unionByName(more))
    classes = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).distinct().join(nodes.select("node", "least"), "node")
    order = F.struct(F.col("least").isNull(), F.col("least"), F.col("node"))
    stays = classes.groupBy("root").agg(F.min_by("node", order).alias("class"))
    return classes.join(stays, "root").select("node", "class")


def keep_first_similar(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", most: int = BUCKET) -> DataFrame:
    """``docs`` with one row of each class of similar texts, and of what is left one row of each SimHash class.

    All columns stay as they are. Texts without words are one class (their
    fingerprints are equal), equal texts are one, null ids come last. A text
    that only a removed one ties to others stays.
    """
    sketched = materialize(sketches(docs, id_column, text_column), "similar-sketches")
    gone = materialize(classes_of(sketched, most).filter("node <> class").select("node"), "similar-gone")
    left = sketched.join(gone, "node", "left_anti").select(F.col("id").alias(id_column), "fingerprint")
    return keep_first(docs, id_column, text_column, among=left)
