"""Prefix trie of conversations: minimal-perfect-hash node tables, totals accumulated in flat arrays by depth.

A node is a distinct sequence of first turns. Its digest is a polynomial hash
of the turns' MD5 digests over the prime 2**127 - 1, which can be put together
from pieces: conversations stand in one sort of the table, tasks hash what they
hold of each, and pieces of a conversation that runs over several partitions
are joined by their lengths and digests. Equal digests are verified: all rows
of a node must agree on depth, last turn and parent.

Subtree totals. Heads are the root, nodes with more than ``heavy`` members (so
fewer than 65,536 of them) and nodes at every ``cut``-th depth. Nodes below a
head and above the next heads form units of bounded size. Totals of what hangs
under a head are plain grouped sums; heads add up along their own tree by
doubling steps. Then units are dealt into shards of bounded size. A shard gives
every digest a slot by a minimal perfect hash (levels of bit tables; the slot's
stored digest is compared at each look-up), scatters counts into numpy arrays
by slot, looks parents up once, and adds totals to parent slots from the
deepest nodes upwards. Heads enter their parents' unit with their totals.

Defined cases: rows without conv_id take no part. Rows of one turn follow by the
MD5 of role and text; rows without turn come first. Repeated rows are turns of
their own. An empty table has no nodes. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.workspace import materialize

PRIME = (1 << 127) - 1
# Base of the polynomial, any number without pattern below the prime; its inverse takes a turn off a digest.
BASE = int.from_bytes(hashlib.sha256(b"prefix digests").digest()[:15], "big")
UNBASE = pow(BASE, -1, PRIME)
ROOT = 1

# Fixed values of the contract: conversations that share their first turns.
FAMILY = 20
SHARED = 4

# Members from which a node is a head, unless a table's size asks for more; heads that such nodes can be at most.
# A unit has at most this many conversations, each with fewer than CUT nodes in it.
HEAVY = 256
MOST_HEAVY = 65_536
# Every so many levels all nodes are heads.
CUT = 256
SHARD_NODES = 65_536
LEAST_SHARDS = 64
# Ids that are joined before they are hashed.
ID_SPAN = 4096

WORD = r"[^\x20\x09-\x0D]+"


def joined(before: int, turns: int, after: int) -> int:
    """Digest of a sequence followed by ``turns`` more turns whose own digest is ``after``."""
    return (before * pow(BASE, turns, PRIME) + after) % PRIME


def _halves(values: list[int]) -> list[pa.Array]:
    """A list of 127-bit numbers as two long columns."""
    pairs = np.array([(v >> 64, v & 0xFFFFFFFFFFFFFFFF) for v in values], dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]


def _wholes(high: list[int], low: list[int]) -> list[int]:
    return [(h << 64) | (x & 0xFFFFFFFFFFFFFFFF) for h, x in zip(high, low, strict=True)]


def turn_digests(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, words`` of every row with an id; the digest stands for role and text."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    body = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(body.cast("binary"))).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def prefix_digests(rows: DataFrame) -> DataFrame:
    """``conv_id, place, h1, h2, digest, words``: place of each turn from 1, digest of all turns up to it."""

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, head, place, value = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            places, values = [], []
            for conv_id, digest in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist(), strict=True):
                if conv_id != head:
                    head, place, value = conv_id, 0, 0
                place, value = place + 1, (value * BASE + int.from_bytes(digest, "big")) % PRIME
                places.append(place)
                values.append(value)
            kept = [batch.column(c) for c in ("conv_id", "digest", "words")]
            arrays = [*kept, pa.array([part] * batch.num_rows, pa.int32()), pa.array(places, pa.int64()), *_halves(values)]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "digest", "words", "part", "place", "h1", "h2"])

    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    stands = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = materialize(stands.mapInArrow(within, "conv_id long, digest binary, words long, part int, place long, h1 long, h2 long"), "trie-pieces")
    before = _pieces_before(pieces)

    def onward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name).to_pylist() for name in ("conv_id", "part", "place", "h1", "h2")}
            places, values = c["place"], _wholes(c["h1"], c["h2"])
            for i, key in enumerate(zip(c["conv_id"], c["part"], strict=True)):
                earlier, value = before.get(key, (0, ROOT))
                values[i] = joined(value, places[i], values[i])
                places[i] += earlier
            arrays = [batch.column("conv_id"), pa.array(places, pa.int64()), *_halves(values), batch.column("digest"), batch.column("words")]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "place", "h1", "h2", "digest", "words"])

    return pieces.mapInArrow(onward, "conv_id long, place long, h1 long, h2 long, digest binary, words long")


def _pieces_before(pieces: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """Turns and digest before a piece, for conversations in several partitions: at most two pieces a partition."""
    ends = pieces.groupBy("conv_id", "part").agg(F.max("place").alias("n"), F.max_by(F.struct("h1", "h2"), "place").alias("h"))
    several = ends.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).filter(F.col("parts") > 1)
    rows = ends.join(several, "conv_id").select("conv_id", "part", "n", "h.h1", "h.h2").collect()
    out: dict[tuple[int, int], tuple[int, int]] = {}
    head, place, value = None, 0, ROOT
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["part"])):
        if r["conv_id"] != head:
            head, place, value = r["conv_id"], 0, ROOT
        out[r["conv_id"], r["part"]] = (place, value)
        place, value = place + r["n"], joined(value, r["n"], *_wholes([r["h1"]], [r["h2"]]))
    return out


def rebuilt_rows(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv_id, n, h1, h2``: rebuilt length and digest, of the last turn) and their rebuilt rows.

    Rows are ``conv_id, depth, h1, h2, g1, g2, link, words``: digests of the node and its parent and a check
    of the last turn.
    """
    early = [F.max(F.when(F.col("place") == i, F.struct("h1", "h2", "digest", "words"))).alias(f"t{i}") for i in range(1, SHARED)]
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("turns"), *early)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    first = convs.select(F.col("conv_id").alias("anchor"), F.col("turns").alias("there"), *[F.col(f"t{i}").alias(f"a{i}") for i in range(1, SHARED)])
    convs = convs.withColumn("skip", h).withColumn("anchor", F.col("conv_id") - F.col("conv_id") % FAMILY).join(first, "anchor", "left")
    convs = convs.withColumn("given", F.least("skip", F.coalesce("there", F.lit(0))))

    def at(prefix: str, place: Column) -> Column:
        found = F.when(place == 1, F.col(f"{prefix}1"))
        for i in range(2, SHARED):
            found = found.when(place == i, F.col(f"{prefix}{i}"))
        return found

    convs = convs.withColumn("new", at("a", F.col("given"))).withColumn("old", at("t", F.least("skip", "turns")))
    convs = materialize(convs, "trie-conversations")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digests of rows whose first ``skip`` turns were exchanged for ``given`` others, and of their parents."""
        for batch in batches:
            c = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            own, new, old = (_wholes(c[f"{x}1"], c[f"{x}2"]) for x in ("h", "n", "o"))
            values, parents = [], []
            for value, place, skip, a, b, digest in zip(own, c["place"], c["skip"], new, old, c["digest"], strict=True):
                if a != b:
                    value = (value + (a - b) * pow(BASE, place - skip, PRIME)) % PRIME
                values.append(value)
                parents.append((value - int.from_bytes(digest, "big")) * UNBASE % PRIME)
            arrays = [batch.column("conv_id"), batch.column("depth"), *_halves(values), *_halves(parents), batch.column("link"), batch.column("words")]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "depth", "h1", "h2", "g1", "g2", "link", "words"])

    def half(struct: str, name: str, alias: str) -> Column:
        return F.coalesce(F.col(f"{struct}.{name}"), F.lit(0 if name == "h1" else ROOT)).alias(alias)

    link = F.xxhash64("digest").alias("link")
    own = turns.join(convs.select("conv_id", "skip", "given", "new", "old"), "conv_id").filter(F.col("place") > F.col("skip"))
    own = own.select(
        "conv_id", "place", "skip", "h1", "h2", "digest", "words", link, (F.col("given") + F.col("place") - F.col("skip")).alias("depth"),
        half("new", "h1", "n1"), half("new", "h2", "n2"), half("old", "h1", "o1"), half("old", "h2", "o2"),
    )
    taken = convs.select("conv_id", "given", F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("place"), F.col(f"a{i}").alias("turn")) for i in range(1, SHARED)])).alias("a"))
    taken = taken.filter(F.col("a.place") <= F.col("given")).select("conv_id", "a.place", "a.turn.*")
    zero = F.lit(0).cast("long")
    taken = taken.select(
        "conv_id", "place", zero.alias("skip"), "h1", "h2", "digest", "words", link, F.col("place").alias("depth"),
        *[zero.alias(name) for name in ("n1", "n2", "o1", "o2")],
    )
    schema = "conv_id long, depth long, h1 long, h2 long, g1 long, g2 long, link long, words long"
    rows = materialize(own.unionByName(taken).mapInArrow(placed, schema), "trie-rows")
    length = F.col("given") + F.greatest(F.col("turns") - F.col("skip"), F.lit(0))
    return convs.select("conv_id", length.alias("n")), rows


def enumerate_nodes(rows: DataFrame) -> DataFrame:
    """Distinct prefixes below the root, each verified: its rows agree on depth, parent and last turn."""
    same = ["depth", "link", "g1", "g2", "words"]
    nodes = rows.groupBy("h1", "h2").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        *[F.min(c).alias(c) for c in same],
        *[F.max(c).alias(f"{c}_") for c in same],
    )
    differs = F.lit(False)
    for c in same:
        differs = differs | (F.col(c) != F.col(f"{c}_"))
    sound = F.when(differs, F.raise_error(F.lit("two prefixes share a digest")).cast("long")).otherwise(F.col("n_convs"))
    return nodes.withColumn("n_convs", sound).drop(*[f"{c}_" for c in same], "link")


def end_hashes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """``h1, h2, ends_sha256`` of the nodes at which conversations end, ids ascending, joined by commas."""
    last = rows.join(convs, "conv_id").filter(F.col("depth") == F.col("n")).select("h1", "h2", "conv_id")
    bare = convs.filter(F.col("n") == 0).select(F.lit(0).cast("long").alias("h1"), F.lit(ROOT).cast("long").alias("h2"), "conv_id")
    ids = last.union(bare).withColumn("span", F.floor(F.col("conv_id") / ID_SPAN))
    spans = ids.groupBy("h1", "h2", "span").agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha, out = None, hashlib.sha256(), []
        for batch in batches:
            for h1, h2, ids in zip(*(batch.column(c).to_pylist() for c in ("h1", "h2", "ids")), strict=True):
                if (h1, h2) == head:
                    sha.update(f",{ids}".encode())
                    continue
                if head is not None:
                    out.append((*head, sha.hexdigest()))
                head, sha = (h1, h2), hashlib.sha256(ids.encode())
            yield _hashes(out)
            out = []
        if head is not None:
            yield _hashes([(*head, sha.hexdigest())])

    def _hashes(out: list[tuple[int, int, str]]) -> pa.RecordBatch:
        h1, h2, hexes = zip(*out, strict=True) if out else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(hexes, pa.string())], names=["h1", "h2", "ends_sha256"])

    ordered = spans.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "span").select("h1", "h2", "ids")
    return ordered.mapInArrow(digest, "h1 long, h2 long, ends_sha256 string")


class NodeTable:
    """Minimal perfect hash of 128-bit digests: a slot below ``len`` for each, none twice."""

    def __init__(self, keys: np.ndarray, load: float = 1.5) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, before = np.arange(len(keys)), 0
        while len(left):
            size = max(64, int(load * len(left)))
            places = self._places(keys[left], len(self.levels), size)
            alone = np.bincount(places, minlength=size) == 1
            self.levels.append((alone, before + np.cumsum(alone) - alone))
            before += int(alone.sum())
            left = left[~alone[places]]
        self.stored = np.zeros_like(keys)
        slots = self._slots(keys)
        self.stored[slots] = keys
        self.slots = slots

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = keys[:, 0] ^ np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + keys[:, 1]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            places = self._places(keys[left], level, len(alone))
            met = alone[places]
            slots[left[met]] = rank[places[met]]
            left = left[~met]
        return slots

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of ``keys``, -1 for those that are not in the table."""
        slots = self._slots(keys)
        return np.where((slots >= 0) & (self.stored[slots] == keys).all(axis=1), slots, -1)


def accumulate(keys: np.ndarray, parents: np.ndarray, tops: np.ndarray, depths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree totals of ``values`` (a column each), through parent slots from the deepest nodes up to the units' tops."""
    table = NodeTable(keys)
    n = len(keys)
    totals, parent, depth = np.zeros_like(values), np.empty(n, np.int64), np.empty(n, np.int64)
    totals[table.slots], parent[table.slots], depth[table.slots] = values, np.where(tops, -1, table.find(parents)), depths
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        inside = level[parent[level] >= 0]
        np.add.at(totals, parent[inside], totals[inside])
    return totals[table.slots]


def _head_totals(heads: DataFrame) -> DataFrame:
    """Totals over the tree of heads (``h1, h2, a1, a2, leaves, saved``; a: the next head above), by doubling."""
    current = heads
    while not current.filter(F.col("a1").isNotNull()).isEmpty():
        sums = current.filter(F.col("a1").isNotNull()).groupBy("a1", "a2").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        sums = sums.select(F.col("a1").alias("h1"), F.col("a2").alias("h2"), "l", "s")
        above = current.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
        step = current.join(sums, ["h1", "h2"], "left").join(above, ["a1", "a2"], "left")
        current = materialize(
            step.select(
                "h1", "h2", F.col("b1").alias("a1"), F.col("b2").alias("a2"),
                (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
            ),
            "trie-heads",
        )
    return current.select("h1", "h2", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def prefix_trie(conversations: DataFrame, heavy: int = HEAVY, cut: int = CUT) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations, the root included."""
    convs, rows = rebuilt_rows(prefix_digests(turn_digests(conversations)))
    total = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).first()
    heavy = max(heavy, -(-rows.count() // MOST_HEAVY))
    root = conversations.sparkSession.range(1 if total["n"] else 0).select(
        F.lit(0).cast("long").alias("h1"), F.lit(ROOT).cast("long").alias("h2"), F.lit(total["least"]).cast("long").alias("conv_id"),
        F.lit(total["n"]).alias("n_convs"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("g1"),
        F.lit(None).cast("long").alias("g2"), F.lit(0).cast("long").alias("words"),
    )
    nodes = enumerate_nodes(rows).unionByName(root)
    nodes = materialize(nodes, "trie-nodes")
    below = nodes.filter(F.col("depth") > 0)
    children = below.groupBy(F.col("g1").alias("h1"), F.col("g2").alias("h2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["h1", "h2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))

    # Depth of the last heavy node on each path; heavy nodes are at most MOST_HEAVY, as each has more than 1/MOST_HEAVY of all rows.
    stout = F.broadcast(below.filter(F.col("n_convs") > heavy).select("h1", "h2"))
    reach = rows.join(stout, ["h1", "h2"], "left_semi").groupBy("conv_id").agg(F.max("depth").alias("reach"))
    nodes = nodes.join(reach, "conv_id", "left").withColumn("reach", F.coalesce("reach", F.lit(0)))
    depth = F.col("depth")
    cut_above = F.floor((depth - 1) / cut) * cut
    nodes = nodes.withColumn("is_head", (depth <= F.col("reach")) | (depth % cut == 0)).withColumn(
        "top", F.when(depth <= F.col("reach"), depth).when(depth > 0, F.greatest("reach", cut_above) + 1)
    )
    # The first node below the next head above: its digest names the unit, its parent is that head.
    tops = rows.select("conv_id", F.col("depth").alias("top"), F.col("h1").alias("u1"), F.col("h2").alias("u2"), F.col("g1").alias("a1"), F.col("g2").alias("a2"))
    nodes = nodes.join(tops, ["conv_id", "top"], "left")
    nodes = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("own", (F.col("n_convs") - 1) * F.col("words"))
    nodes = materialize(nodes, "trie-units")

    light, heads = nodes.filter(~F.col("is_head")), nodes.filter("is_head")
    hanging = light.groupBy(F.col("a1").alias("h1"), F.col("a2").alias("h2")).agg(F.sum("leaf").alias("l"), F.sum("own").alias("s"))
    start = heads.join(hanging, ["h1", "h2"], "left").select(
        "h1", "h2", "a1", "a2", (F.col("leaf") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("own") + F.coalesce("s", F.lit(0))).alias("saved")
    )
    totals = _head_totals(materialize(start, "trie-heads"))
    heads = materialize(heads.join(totals, ["h1", "h2"]), "trie-head-totals")

    shards = max(LEAST_SHARDS, -(-light.count() // SHARD_NODES))
    given = heads.filter(F.col("depth") != F.col("top")).withColumn("leaf", F.col("n_leaves")).withColumn("own", F.col("saved_tokens"))
    units = light.unionByName(given, allowMissingColumns=True)
    units = units.select("h1", "h2", "g1", "g2", "depth", "leaf", "own", "is_head", (F.col("depth") == F.col("top")).alias("is_top"), F.pmod(F.xxhash64("u1", "u2"), F.lit(shards)).alias("shard"))

    def totals_of(table: pa.Table) -> pa.Table:
        def pair(a: str, b: str) -> np.ndarray:
            return np.stack([table.column(a).to_numpy(), table.column(b).to_numpy()], axis=1).astype(np.int64).view(np.uint64)

        values = np.stack([table.column("leaf").to_numpy(), table.column("own").to_numpy()], axis=1).astype(np.int64)
        tops = table.column("is_top").to_numpy()
        sums = accumulate(pair("h1", "h2"), pair("g1", "g2"), tops, table.column("depth").to_numpy(), values)
        out = pa.table({"h1": table.column("h1"), "h2": table.column("h2"), "n_leaves": pa.array(sums[:, 0]), "saved_tokens": pa.array(sums[:, 1])})
        return out.filter(pc.invert(table.column("is_head")))

    summed = units.groupBy("shard").applyInArrow(totals_of, "h1 long, h2 long, n_leaves long, saved_tokens long")
    every = heads.unionByName(light.join(summed, ["h1", "h2"]), allowMissingColumns=True)

    # The parent's smallest member: heavy parents are few; any other has at most ``heavy`` children.
    parents = nodes.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("conv_id").alias("parent_conv_id"), "n_convs", "depth")
    is_stout = (F.col("n_convs") > heavy) | (F.col("depth") == 0)
    known = F.broadcast(parents.filter(is_stout).select("g1", "g2", F.col("parent_conv_id").alias("stout_id")))
    others = parents.filter(~is_stout).select("g1", "g2", "parent_conv_id")
    every = every.join(known, ["g1", "g2"], "left")
    found = every.filter(F.col("stout_id").isNotNull() | (F.col("depth") == 0)).withColumn("parent_conv_id", F.col("stout_id"))
    sought = every.filter(F.col("stout_id").isNull() & (F.col("depth") > 0)).join(others, ["g1", "g2"], "left")
    every = found.unionByName(sought).join(end_hashes(rows, convs), ["h1", "h2"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return every.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")
    )
