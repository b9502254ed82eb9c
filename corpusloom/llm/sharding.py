"""Sharding by balanced label propagation.

Documents that share a group (here: an equal text) are linked. All rows start
in shards of exactly equal counts. In each round every group looks at how many
of its rows each shard holds, and its rows ask to move to the shard that holds
most of their neighbours. Moves are exchanged between the shards: each admits
as many rows as leave it in the same round, and what it has room for. Rows
without links then fill the shards up, so counts stay at most one apart (law
``rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.ranks import ranked
from corpusloom.plans.workspace import materialize

SHARDS = 16
# Rounds in a row without a move after which none is looked for; targets and ties differ from round to round.
IDLE_ROUNDS = 3


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    rounds: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    ``size`` is the UTF-8 length of the text plus 1 (1 for null), ``slot`` is
    gapless from 0 in each shard, ``grown_shard`` is null under this law. Rows
    with equal texts are linked, null texts with nothing; a group larger than a
    shard's quota fills shards one after the other. ``rounds`` bounds the rounds
    of moves; without it they end when no move brings equal texts together. Ids are never joined on, so
    null and repeated ids and repeated rows are rows like any others. An empty
    table gives an empty result. Other columns are ignored.
    """
    body = F.col(text_column).cast("binary")
    rows = docs.select(
        F.col(id_column).alias("id"),
        (F.coalesce(F.octet_length(text_column), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.unhex(F.md5(body)).alias("group"),
    )
    rows = materialize(rows.withColumn("h", F.xxhash64(F.lit("shard"), "id", "group", "size")), "shard-rows")
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    groups = rows.filter(F.col("group").isNotNull()).groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    linked_groups = materialize(groups.filter("members > 1"), "shard-groups")
    started = ranked(rows, [], F.col("h"), total).withColumn("shard", shard_at(F.col("rank"), quotas)).drop("rank")
    state = materialize(started.join(linked_groups, "group", "left"), "shard-start")
    linked, single = state.filter("members IS NOT NULL"), state.filter("members IS NULL")
    start = linked.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("here"), F.first("members").alias("members"))
    cells = propagate(materialize(start, "shard-linked"), quotas, rounds)
    placed = fill(settle(linked, cells, total), single, cells, quotas, total)
    slots = ranked(placed, ["shard"], F.xxhash64(F.lit("slot"), "h", "id"), total, "slot")
    return slots.select(
        F.col("id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_at(position: Column, rooms: list[int]) -> Column:
    """The shard whose stretch of ``rooms`` holds the position."""
    ends, seen = [], 0
    for room in rooms:
        seen += room
        ends.append(seen)
    return F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends[:-1]]), lambda e: e <= position)).cast("int") if len(
        rooms
    ) > 1 else F.lit(0)


def propagate(cells: DataFrame, quotas: list[int], rounds: int | None) -> DataFrame:
    """Rounds of moves of linked rows towards their neighbours' shards, until none brings neighbours together.

    Rows of a group are alike, so a round moves counts: ``group, shard, here,
    members``. Moves are exchanged: a shard admits what it has room for and as
    many rows as leave it in the same round, so it is never over its quota.
    """
    shards, turn, idle, closed = len(quotas), 0, 0, set()
    rooms = [q - n for q, n in zip(quotas, held(cells, shards), strict=True)]
    n_cells = cells.count()
    # Every move but that of a whole group adds to the linked pairs within shards, so this ends.
    while idle < IDLE_ROUNDS and (rounds is None or turn < rounds):
        asking = materialize(moves(cells, quotas, closed, turn), "shard-cells")
        wishes = asking.filter("target IS NOT NULL")
        asks = matrix(wishes, "shard", "target", "here", shards)
        if not any(map(any, asks)):
            if not closed:
                break
            closed, turn = set(), turn + 1
            continue
        admitted = exchange(asks, rooms)
        rest = [[asks[s][t] - admitted[s][t] for t in range(shards)] for s in range(shards)]
        whole = swaps(asking, rest, turn, n_cells)
        if whole is not None:
            # Whole groups that lose no link by it make way for rows that are still refused.
            whole = materialize(whole, "shard-swaps")
            back = matrix(whole, "shard", "target", "here", shards)
            admitted = [[admitted[s][t] + back[t][s] for t in range(shards)] for s in range(shards)]
        goes = ranked(wishes, ["shard", "target"], in_turn(quotas, turn), n_cells, weight="here")
        granted = F.element_at(flat(admitted), F.col("shard") * shards + F.col("target") + 1)
        goes = goes.withColumn("go", F.greatest(F.least(granted - F.col("before"), F.col("here")), F.lit(0)))
        moved = goes.select("group", "shard", "target", "go")
        if whole is not None:
            moved = moved.unionByName(whole.select("group", "shard", "target", F.col("here").alias("go")))
        known = asking.drop("target").join(moved, ["group", "shard"], "left")
        left = F.col("here") - F.coalesce("go", F.lit(0))
        parts = F.array(
            F.struct("shard", left.alias("here")), F.struct(F.col("target").alias("shard"), F.coalesce("go", F.lit(0)).alias("here"))
        )
        split = known.select("group", "members", F.inline(F.filter(parts, lambda p: p["here"] > 0)))
        summed = split.groupBy("group", "shard").agg(F.sum("here").alias("here"), F.first("members").alias("members"))
        cells = materialize(summed, "shard-round")
        into = [sum(admitted[s][t] for s in range(shards)) for t in range(shards)]
        if whole is None:
            back = [[0] * shards for _ in range(shards)]
        for s in range(shards):
            rooms[s] += sum(admitted[s]) + sum(back[s]) - into[s] - sum(back[t][s] for t in range(shards))
        # Shards that admit nobody are passed over once, so that rows try their next best.
        closed = {t for t in range(shards) if not into[t] and any(asks[s][t] for s in range(shards))}
        idle = 0 if any(into) else idle + 1
        turn += 1
    return cells


def exchange(asks: list[list[int]], rooms: list[int]) -> list[list[int]]:
    """Rows admitted from shard to shard: along cycles first, then into rooms, which moves out make larger."""
    shards, left, rooms = len(asks), [list(row) for row in asks], list(rooms)
    for s in range(shards):
        for t in range(s):
            both = min(left[s][t], left[t][s])
            left[s][t] -= both
            left[t][s] -= both
    while True:
        follow = {s: {t for t in range(shards) if left[s][t]} for s in range(shards)}
        while dead := [s for s in follow if not follow[s]]:
            for s in dead:
                del follow[s]
            for targets in follow.values():
                targets.difference_update(dead)
        if not follow:
            break
        path = [min(follow)]
        while (step := min(follow[path[-1]])) not in path:
            path.append(step)
        cycle = path[path.index(step) :]
        edges = list(zip(cycle, cycle[1:] + cycle[:1], strict=True))
        least = min(left[s][t] for s, t in edges)
        for s, t in edges:
            left[s][t] -= least
    more = True
    while more:
        more = False
        for t in range(shards):
            for s in range(shards):
                n = min(left[s][t], rooms[t])
                if n > 0:
                    left[s][t] -= n
                    rooms[t] -= n
                    rooms[s] += n
                    more = True
    return [[asks[s][t] - left[s][t] for t in range(shards)] for s in range(shards)]


def swaps(asking: DataFrame, rest: list[list[int]], turn: int, n_cells: int) -> DataFrame | None:
    """Small groups that are together and go as they are where refused rows come from; no more rows than those."""
    shards = len(rest)
    if not any(map(any, rest)):
        return None
    ends = [[0] * shards for _ in range(shards)]
    for t in range(shards):
        seen = 0
        for s in range(shards):
            seen += rest[s][t]
            ends[t][s] = seen
    most = F.element_at(F.array(*[F.lit(row[-1]).cast("long") for row in ends]), F.col("shard") + 1)
    idle = asking.filter((F.col("here") == F.col("members")) & (F.col("here") <= most)).drop("target")
    order = F.xxhash64(F.lit(f"swap {turn}"), "group")
    placed = ranked(idle, ["shard"], order, n_cells, weight="here")
    own = F.slice(flat(ends), F.col("shard") * shards + 1, F.lit(shards))
    target = F.size(F.filter(own, lambda e: e <= F.col("before"))).cast("int")
    placed = placed.withColumn("ends", own).withColumn("target", target).filter(F.col("target") < shards)
    fits = F.col("before") + F.col("here") <= F.element_at("ends", F.col("target") + 1)
    return placed.filter(fits).select("group", "shard", "target", "here")


def flat(table: list[list[int]]) -> Column:
    return F.array(*[F.lit(n).cast("long") for row in table for n in row])


def matrix(cells: DataFrame, row: str, column: str, number: str, shards: int) -> list[list[int]]:
    """Sums per pair of shards."""
    sums = {(s, t): n for s, t, n in cells.groupBy(row, column).agg(F.sum(number)).collect()}
    return [[sums.get((s, t), 0) for t in range(shards)] for s in range(shards)]


def is_large(quotas: list[int]) -> Column:
    """Groups that hold a good part of a shard."""
    return F.col("members") * 64 > max(quotas)


def in_turn(quotas: list[int], turn: int) -> Column:
    """The order in which rows are admitted: small groups first; a new draw each round, else those refused once would be refused for good."""
    half = F.shiftrightunsigned(F.xxhash64(F.lit(f"unit {turn}"), "group"), 1)
    return F.when(is_large(quotas), half.bitwiseOR(F.lit(-(1 << 63)))).otherwise(half)


def held(cells: DataFrame, shards: int) -> list[int]:
    """Rows per shard: as many numbers as there are shards."""
    sums = {s: n for s, n in cells.groupBy("shard").agg(F.sum("here")).collect()}
    return [sums.get(s, 0) for s in range(shards)]


def moves(cells: DataFrame, quotas: list[int], closed: set[int], turn: int) -> DataFrame:
    """``cells`` with ``target``: the shard with most neighbours that this group does not fill and that is not closed.

    It is null where the rows stay. Ties are drawn anew each round, so that equal halves ask in either direction.
    """
    weight = F.struct("here", F.xxhash64(F.lit(turn), "group", "shard").alias("tie"), "shard")
    quota = F.element_at(F.array(*[F.lit(q).cast("long") for q in quotas]), F.col("shard") + 1)
    free = (F.col("here") < quota) & ~F.col("shard").isin(sorted(closed)) if closed else F.col("here") < quota
    best = F.max(F.when(free, weight)).over(Window.partitionBy("group"))
    marked = cells.withColumn("own", weight).withColumn("best", best)
    target = F.when(F.col("best") > F.col("own"), F.col("best.shard"))
    return marked.select("group", "shard", "here", "members", target.alias("target"))


def settle(linked: DataFrame, cells: DataFrame, total: int) -> DataFrame:
    """Linked rows with the shards of their group's cells; which row of a group goes where is drawn."""
    run = F.sum("here").over(Window.partitionBy("group").orderBy("shard"))
    ends = F.sort_array(F.collect_list(F.struct("end", F.col("shard").alias("to"))))
    table = cells.withColumn("end", run).groupBy("group").agg(ends.alias("ends"))
    placed = ranked(linked.drop("shard"), ["group"], F.xxhash64(F.lit("settle"), "h"), total, "place")
    shard = F.element_at(F.filter("ends", lambda e: e["end"] > F.col("place")), 1)["to"]
    return placed.join(table, "group").withColumn("shard", shard)


def fill(linked: DataFrame, single: DataFrame, cells: DataFrame, quotas: list[int], total: int) -> DataFrame:
    """Rows without links go where linked rows leave room; exact quotas."""
    columns = ["id", "size", "text_crc32", "h", "shard"]
    rooms = [q - n for q, n in zip(quotas, held(cells, len(quotas)), strict=True)]
    dealt = ranked(single, [], F.xxhash64(F.lit("pool"), "h"), total).withColumn("shard", shard_at(F.col("rank"), rooms))
    return linked.select(*columns).unionByName(dealt.select(*columns))
