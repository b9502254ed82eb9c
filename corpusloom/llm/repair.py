"""Conversation structure repair: cheapest edits found by the auction algorithm for shortest paths.

A conversation is a lattice: one column of nodes per row, one node per state of
the role pattern ``(s?(ua)+)?``; edits are arcs with whole costs. The auction
algorithm keeps a path and node prices with ``price(i) <= cost(i, j) + price(j)``
on all arcs and equality along the path. It extends the path over the best arc
of its last node, or raises that node's price to the best arc's and contracts
the path. Prices start at what faulty rows cost in any case. When a path
arrives, the price of its origin is its cost; arcs that hold with equality are
tight, and the least letters among them give the audit. A node's price is
settled by an auction from that node before its arcs are compared.

Conversations are cut into blocks of bounded rows and bytes wherever they stand
in one sort of the table, so a conversation of any length is many blocks over
many tasks. Every block's costs between its four entry and four exit states are
found in parallel; a pass from each conversation's last block to its first
gives what each exit costs from there on (16 numbers a block are all it moves),
then blocks are traced in parallel for each entry state, and a last pass in
order picks the entries and feeds the SHA-256 digest, one block at a time.

Defined cases: null ids, roles and texts are one space. Rows of a conversation
follow by turn, nulls first, then by the MD5 of role and text. A conversation
whose rows are all dropped, or that has none but dropped ones, has zeros, an
empty audit and the digest of the empty string. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.texts import byte_slices
from corpusloom.plans.workspace import materialize

# Rows and bytes of a block; a row larger than that is a block of its own.
BLOCK_ROWS = 64
BLOCK_BYTES = 1 << 20

# Fixed values of the contract: costs of the edits.
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3

# Pattern states: 0 nothing yet, 1 after s, 2 after u, 3 after a. What each role initial leads to.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
# The role that an insertion or a new role gives in each state, as no other fits the pattern.
FITS = ("u", "u", "a", "u")
ENDS = (0, 3)
STATES = 4
NEVER = 1 << 60
ROLES = {"u": "user", "a": "assistant"}

# Faults of a row, first that holds.
SOUND, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3

BLOCK = "conv_id long, no_id boolean, block long, roles array<string>, texts array<string>, faults array<int>, gone long, turns array<long>, costs array<long>"


def arcs(initial: str, fault: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of one row from a state: letter, cost and next state, in the order of the letters."""
    out = [("D", DELETE, state)]
    if fault in (BLANK, DUPLICATE):
        return out
    more = UNFINISHED if fault == TRUNCATED else 0
    if (after := STEP[state].get(initial)) is not None:
        out.append(("K", more, after))
    out.append(("R", REROLE + more, STEP[state][FITS[state]]))
    return out


class Auction:
    """Prices of the lattice of some rows, towards exits that cost ``leave[state]`` each."""

    def __init__(self, rows: list[tuple[str, int]], leave: list[int]) -> None:
        self.n = len(rows)
        least = [{SOUND: 0, TRUNCATED: UNFINISHED}.get(fault, DELETE) for _, fault in rows]
        floor = [min(leave)] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            floor[i] = floor[i + 1] + least[i]
        self.prices = [floor[i] for i in range(self.n + 1) for _ in range(STATES)]
        self.exit = STATES * (self.n + 1)
        self.prices.append(0)
        self.out: list[list[tuple[str, int, int]]] = []
        for i in range(self.n + 1):
            for state in range(STATES):
                ways = [] if i == self.n else [(e, c, STATES * (i + 1) + s) for e, c, s in arcs(*rows[i], state)]
                ways.append(("I", INSERT, STATES * i + STEP[state][FITS[state]]))
                if i == self.n and leave[state] < NEVER:
                    ways.append(("", leave[state], self.exit))
                self.out.append(sorted(ways))

    def cost(self, origin: int) -> int:
        """Settle the price of ``origin``: the auction ends when its path arrives."""
        prices, path = self.prices, [origin]
        while path[-1] != self.exit:
            node = path[-1]
            _, cost, after = min(self.out[node], key=lambda way: way[1] + prices[way[2]])
            if prices[node] < (best := cost + prices[after]):
                prices[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(after)
        return prices[origin]

    def trace(self, state: int) -> tuple[str, int]:
        """The least letters over tight arcs from an entry state, and the exit state."""
        node, audit = state, []
        self.cost(node)
        while True:
            for letter, cost, after in self.out[node]:
                # The price of the next node is settled first: a lower one would make a dear arc look tight.
                if self.prices[node] == cost + self.prices[after] and (after == self.exit or self.prices[node] == cost + self.cost(after)):
                    break
            if after == self.exit:
                return "".join(audit), node % STATES
            audit.append(letter)
            node = after


def costs_between(rows: list[tuple[str, int]]) -> list[int]:
    """Cheapest edits of a block from each entry state (rows) to each exit state (columns); NEVER where no edits lead."""
    out = [NEVER] * STATES**2
    for end in range(STATES):
        auction = Auction(rows, [0 if s == end else NEVER for s in range(STATES)])
        for start in range(STATES):
            if end >= 2 or _reaches(rows, start, end):
                out[STATES * start + end] = auction.cost(start)
    return out


def _reaches(rows: list[tuple[str, int]], start: int, end: int) -> bool:
    """Whether states without insertions that lead to them (nothing yet, after s) can still be met at the end."""
    if start > 1 or start > end:
        return False
    return start == end or any(initial == "s" and fault in (SOUND, TRUNCATED) for initial, fault in rows)


def repaired(audit: str, roles: list[str], texts: list[str], state: int) -> list[str]:
    """``role:text`` of the rows that the edits leave."""
    out, i = [], 0
    for letter in audit:
        if letter in "IR":
            out.append(f"{ROLES[FITS[state]]}:{texts[i] if letter == 'R' else ''}")
            state = STEP[state][FITS[state]]
        elif letter == "K":
            out.append(f"{roles[i]}:{texts[i]}")
            state = STEP[state][roles[i][:1]]
        i += letter != "I"
    return out


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, no_id, turn, role, text, gone`` after the damage; dropped rows stay, marked ``gone``."""
    space = F.lit(" ")
    told = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return told.withColumn("kind", F.crc32(key.cast("binary")) % 20).select(
        F.coalesce("conv_id", F.lit(0)).alias("conv_id"),
        F.col("conv_id").isNull().alias("no_id"),
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def _digest() -> Column:
    return F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Faults told per row, sorted over partitions by conversation and turn."""
    place = [F.col("turn").isNotNull().alias("dated"), F.coalesce("turn", F.lit(0)).alias("at")]
    rows = rows.withColumn("digest", _digest()).withColumn("place", F.struct(*place))
    same = ["no_id", "conv_id", "digest"]
    repeats = rows.filter(~F.col("gone")).groupBy(*same).agg(F.min("place").alias("first"), F.max("place").alias("last"))
    repeats = repeats.filter(F.col("first") < F.col("last")).drop("last")
    told = rows.join(repeats, same, "left").select(
        "no_id", "conv_id", "turn", "digest", "role", "text", "gone",
        F.when(~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), BLANK)
        .when(F.col("place") > F.col("first"), DUPLICATE)
        .when(~F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z")), TRUNCATED)
        .otherwise(SOUND)
        .alias("fault"),
    )
    keys = ["no_id", "conv_id", F.col("turn").asc_nulls_first(), "digest", "gone"]
    return told.repartitionByRange(*keys).sortWithinPartitions(*keys)


def cut_blocks(rows: DataFrame, limit: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of consecutive rows of one conversation with their costs between states, numbered along the sort."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        head: tuple | None = None
        block: dict = {}
        size, before = 0, None
        ready: list[dict] = []

        def opened(key: tuple) -> dict:
            nonlocal number
            number += 1
            return {"conv_id": key[1], "no_id": key[0], "block": number, "roles": [], "texts": [], "faults": [], "gone": 0, "turns": []}

        def closed() -> None:
            block["costs"] = costs_between([(r[:1], f) for r, f in zip(block["roles"], block["faults"], strict=True)])
            known = [t for t in block.pop("turns") if t is not None]
            block["turns"] = [known[0], known[-1], 1 + sum(a != b for a, b in zip(known, known[1:]))] if known else []
            ready.append(block)

        for batch in (part for whole in batches for part in byte_slices(whole, "text")):
            for no_id, conv_id, turn, digest, role, text, gone, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if head != (no_id, conv_id) or len(block["roles"]) >= limit or size > BLOCK_BYTES:
                    if head is not None:
                        closed()
                    if head != (no_id, conv_id):
                        head, before = (no_id, conv_id), None
                    block, size = opened(head), 0
                if gone:
                    block["gone"] += 1
                    continue
                # Rows equal in turn, role and text stand side by side in one partition.
                if before == (turn, digest) and fault != BLANK:
                    fault = DUPLICATE
                before = (turn, digest)
                size += len(role) + len(text)
                for name, value in (("roles", role), ("texts", text), ("faults", fault), ("turns", turn)):
                    block[name].append(value)
                if len(ready) >= 256 or (ready and size > BLOCK_BYTES):
                    yield pa.RecordBatch.from_pylist(ready, schema=schema)
                    ready.clear()
            if ready:
                yield pa.RecordBatch.from_pylist(ready, schema=schema)
                ready.clear()
        if head is not None:
            closed()
            yield pa.RecordBatch.from_pylist(ready, schema=schema)

    strings, longs = pa.list_(pa.string()), pa.list_(pa.int64())
    schema = pa.schema(
        [("conv_id", pa.int64()), ("no_id", pa.bool_()), ("block", pa.int64()), ("roles", strings), ("texts", strings),
         ("faults", pa.list_(pa.int32())), ("gone", pa.int64()), ("turns", longs), ("costs", longs)]
    )
    return rows.mapInArrow(run, BLOCK)


def _in_streams(df: DataFrame, *order: Column) -> DataFrame:
    """Conversations whole in a sorted stream each; a task holds one row of it at a time."""
    return df.repartition("no_id", "conv_id").sortWithinPartitions("no_id", "conv_id", *order)


def exit_costs(blocks: DataFrame) -> DataFrame:
    """What the rest of a conversation costs after each block, per exit state, from the last block to the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, leave = None, []
        for batch in batches:
            out = []
            for no_id, conv_id, costs in zip(*(batch.column(c).to_pylist() for c in ("no_id", "conv_id", "costs")), strict=True):
                if head != (no_id, conv_id):
                    head, leave = (no_id, conv_id), [0 if s in ENDS else NEVER for s in range(STATES)]
                out.append(leave)
                leave = [min(NEVER, *(costs[STATES * s + e] + leave[e] for e in range(STATES))) for s in range(STATES)]
            yield pa.RecordBatch.from_arrays([*batch.drop_columns(["costs"]).columns, pa.array(out, pa.list_(pa.int64()))], names=["no_id", "conv_id", "block", "initials", "faults", "leave"])

    initials = F.transform("roles", lambda r: F.substring(r, 1, 1)).alias("initials")
    narrow = blocks.select("no_id", "conv_id", "block", initials, "faults", "costs")
    schema = "no_id boolean, conv_id long, block long, initials array<string>, faults array<int>, leave array<long>"
    return _in_streams(narrow, F.col("block").desc()).mapInArrow(run, schema)


def trace_blocks(blocks: DataFrame) -> DataFrame:
    """Audit, exit state and cost of each block for every entry state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, exits, totals = [], [], []
            for initials, faults, leave in zip(*(batch.column(c).to_pylist() for c in ("initials", "faults", "leave")), strict=True):
                auction = Auction(list(zip(initials, faults, strict=True)), leave)
                traced = [auction.trace(state) for state in range(STATES)]
                audits.append([t[0] for t in traced])
                exits.append([t[1] for t in traced])
                totals.append(auction.prices[:STATES])
            kept = [batch.column(c) for c in ("no_id", "conv_id", "block")]
            arrays = [pa.array(audits), pa.array(exits, pa.list_(pa.int32())), pa.array(totals, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], names=["no_id", "conv_id", "block", "audits", "exits", "totals"])

    spread = blocks.repartition("no_id", "conv_id", "block")
    return spread.mapInArrow(run, "no_id boolean, conv_id long, block long, audits array<string>, exits array<int>, totals array<long>")


def assemble(traces: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row per conversation: its blocks in order, each after its traces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, state, sha, trace = None, 0, None, None
        out: dict = {}

        def done() -> pa.RecordBatch:
            span = out.pop("span")
            gaps = span[1] - span[0] + 1 - out.pop("dates") if span else 0
            del out["last"], out["some"]
            row = {"conv_id": None if head[0] else head[1], "gaps": gaps, **out, "audit": "".join(out["audit"]), "repaired_sha256": sha.hexdigest()}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for row in (row for start in range(0, batch.num_rows, 64) for row in batch.slice(start, 64).to_pylist()):
                if head != (row["no_id"], row["conv_id"]):
                    if head is not None:
                        yield done()
                    head, state, sha = (row["no_id"], row["conv_id"]), 0, hashlib.sha256()
                    out = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": None, "audit": [], "span": None, "dates": 0, "last": None, "some": False}
                if row["audits"] is not None:
                    trace = row
                    continue
                audit, initials = trace["audits"][state], [r[:1] for r in row["roles"]]
                for name, fault in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED)):
                    out[name] += row["faults"].count(fault)
                if initials:
                    pairs = zip(initials if out["last"] is None else [out["last"], *initials], initials[1:] if out["last"] is None else initials)
                    out["illegal"] += sum(a + b not in ("su", "ua", "au") for a, b in pairs)
                    out["last"] = initials[-1]
                if row["turns"]:
                    first, last, distinct = row["turns"]
                    out["dates"] += distinct - (out["span"] is not None and out["span"][1] == first)
                    out["span"] = (first if out["span"] is None else out["span"][0], last)
                if out["cost"] is None:
                    out["cost"] = trace["totals"][state]
                for line in repaired(audit, row["roles"], row["texts"], state):
                    sha.update(f"\n{line}".encode() if out["some"] else line.encode())
                    out["some"] = True
                out["audit"].append(audit)
                state = trace["exits"][state]
        if head is not None:
            yield done()

    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", pa.int64()), *((n, pa.int64()) for n in names), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    both = traces.unionByName(blocks.select("no_id", "conv_id", "block", "roles", "texts", "faults", "turns"), allowMissingColumns=True)
    result = "conv_id long, " + ", ".join(f"{n} long" for n in names) + ", audit string, repaired_sha256 string"
    return _in_streams(both, F.col("block"), F.col("audits").isNull()).mapInArrow(run, result)


def repair(conversations: DataFrame, block_rows: int = BLOCK_ROWS, damaged: bool = False) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired rows of every conversation.

    The table is damaged first as the contract says, unless ``damaged`` says
    that its rows are to be taken as they are.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    rows = untouched(rows) if damaged else damage(rows)
    blocks = materialize(cut_blocks(ordered_rows(rows), block_rows), "repair-blocks")
    return assemble(trace_blocks(exit_costs(blocks)), blocks)


def untouched(rows: DataFrame) -> DataFrame:
    space = F.lit(" ")
    return rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"),
        F.col("conv_id").isNull().alias("no_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        F.lit(False).alias("gone"),
    )
