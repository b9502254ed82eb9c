"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source has a target number of words: its weight's share of the total,
bounded by a number of passes over the source. Documents are cut into blocks of
words; whole passes take every block, the last pass takes a permuted prefix of
them, cut to the exact remainder. A tree then divides the block quotas of all
sources among the output shards: at each node the left half's quotas are one
draw from the multivariate hypergeometric distribution, so every shard is an
unbiased sample of the mix with exact sums. Shards draw disjoint stretches of
each source's permuted blocks and carry a key that shuffles them locally.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.ranks import ranked
from corpusloom.plans.workspace import materialize

WORD = r"[^\x20\x09-\x0D]+"
# Fixed values of the contract: weights in the sources' code point order, the mix's size and the passes over a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
SHARDS = 16
# Words of a block; None keeps documents whole.
BLOCK_WORDS = 1024
SEED = "mix-1"
# Words of the mix that one task arranges.
TASK_WORDS = 4 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, passes: int = PASSES
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    Weights repeat along the sources in code point order, null last. A source's
    target stops at ``passes`` times its size; what is cut off goes to the
    others by weight. With sources by the ratio of bound to weight, those that
    meet their bound come first, which gives the fixed point directly. What one
    task orders is a row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    earlier = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    bound = F.lit(float(passes)) * F.col("source_size")
    table = (
        sizes.withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("bound", bound)
        .withColumn("ratio", F.col("bound") / F.col("weight"))
        .withColumn("sum", F.sum("source_size").over(every) * share)
        .withColumn("weights", F.sum("weight").over(every))
        .withColumn("met", F.coalesce(F.sum("bound").over(earlier), F.lit(0.0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
        .withColumn("level", (F.col("sum") - F.col("met")) / (F.col("weights") - F.col("gone")))
        .withColumn("full", F.col("ratio") <= F.col("level"))
        .withColumn("open", F.max(F.when(~F.col("full"), F.col("level"))).over(every))
    )
    target = F.when(F.col("full"), F.col("bound")).otherwise(F.col("weight") * F.col("open"))
    return table.select("source", "source_size", target.alias("target"), "place")


def mix_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    shards: int = SHARDS,
    block_words: int | None = BLOCK_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """The blocks of the mix: ``id, copy, size, source_size, target, block, pass, words, shard, order``.

    ``block`` numbers a document's blocks of ``block_words`` words, ``pass`` the
    passes over a source, ``words`` what the mix takes of the block, ``shard``
    and ``order`` where it goes. Blocks that the mix does not take come once
    with pass, shard and order null and 0 words, so every row of ``docs`` is
    found in the result; ``copy`` numbers rows that agree in id, source and
    size. Null texts have no words, null sources are one source, null ids are
    ids like others. The result depends on the rows and ``seed`` only.
    """
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"), word_count(F.col(text_column)).alias("size")
    )
    same = rows.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    keyed = materialize(same, "mix-documents")
    sizes = keyed.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = materialize(source_targets(sizes, weights, share, passes), "mix-targets")
    width = F.lit(block_words) if block_words else F.greatest(F.col("size"), F.lit(1))
    blocks = (
        keyed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("rows").cast("int") - 1)))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / width) - 1, F.lit(0)))))
        .withColumn("length", F.least(width, F.col("size") - F.col("block") * width).cast("long"))
        .drop("rows")
    )
    n_blocks = blocks.count()
    known = blocks.join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    whole = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0)
    placed = ranked(known.drop("source"), ["place"], last_draw(seed, "id", "size", "copy", "block"), n_blocks, weight="length")
    rest = F.round("target").cast("long") - F.col("whole") * F.col("source_size")
    part = F.greatest(F.least(F.col("rest") - F.col("before"), F.col("length")), F.lit(0))
    units = (
        placed.withColumn("whole", whole.cast("long"))
        .withColumn("rest", rest)
        .withColumn("part", part.cast("long"))
        .withColumn(
            "takes",
            F.filter(
                F.transform(
                    F.sequence(F.lit(1), F.lit(passes)),
                    lambda p: F.struct(
                        p.alias("pass"),
                        F.when(p <= F.col("whole"), F.col("length"))
                        .when(p == F.col("whole") + 1, F.col("part"))
                        .otherwise(0)
                        .alias("words"),
                    ),
                ),
                lambda t: t["words"] > 0,
            ),
        )
        .withColumn("take", F.explode_outer("takes"))
        .select("id", "copy", "size", "place", "source_size", "target", "block", "take.pass", F.coalesce("take.words", F.lit(0)).cast("long").alias("words"))
    )
    units = materialize(units, "mix-units")
    taken, left = units.filter("pass IS NOT NULL"), units.filter("pass IS NULL")
    quotas = taken.groupBy("place").agg(F.count(F.lit(1)).alias("blocks"))
    ends = materialize(shard_ends(split_quotas(quotas, shards, seed), shards), "mix-quotas")
    order = shard_draw(seed, "id", "size", "copy", "block", "pass")
    drawn = ranked(taken, ["place"], order, n_blocks * passes, "drawn").join(ends, "place")
    shard = F.size(F.filter("ends", lambda e: e <= F.col("drawn"))).cast("int")
    drawn = drawn.withColumn("shard", shard).withColumn("order", local_order(seed, "id", "size", "copy", "block", "pass"))
    out = drawn.drop("ends", "drawn").unionByName(left, allowMissingColumns=True)
    return out.withColumnRenamed("id", id_column)


def last_draw(seed: str, *unit: str | Column) -> Column:
    """Where a block stands in the permutation whose prefix the last pass takes."""
    return F.xxhash64(F.lit("last"), F.lit(seed), *unit)


def shard_draw(seed: str, *unit: str | Column) -> Column:
    """Where a taken block stands among those that the shards draw."""
    return F.xxhash64(F.lit(seed), F.lit("draw"), *unit)


def local_order(seed: str, *unit: str | Column) -> Column:
    return F.xxhash64(F.lit(seed), F.lit("local"), *unit)


def in_rank_order(draw: Column) -> Column:
    """Ranks take hashes as unsigned; with the sign bit flipped, signed order is theirs."""
    return draw.bitwiseXOR(F.lit(-(1 << 63)))


def split_quotas(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """``shard, counts``: the ``place, blocks`` quotas of all sources divided among the shards by the tree.

    A row is a node with its range of shards and the quotas of all sources; one
    level of the tree is one projection, so the driver sees no counts.
    """
    parts = F.sort_array(F.collect_list(F.struct("place", F.col("blocks").cast("long").alias("n"))))
    nodes = quotas.agg(parts.alias("counts")).select(
        F.lit(0).alias("low"), F.lit(shards).alias("high"), "counts"
    )
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        nodes = split_level(nodes, seed)
    return nodes.select(F.col("low").alias("shard"), "counts")


def split_level(nodes: DataFrame, seed: str) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c["n"])
    nodes = nodes.withColumn("middle", middle).withColumn("total", total)
    draws = F.floor(F.col("total") * (F.col("middle") - F.col("low")) / (F.col("high") - F.col("low"))).cast("long")
    start = F.struct(
        F.col("total").alias("total"), F.col("draws").alias("draws"), F.array().cast("array<bigint>").alias("out")
    )

    def draw(state: Column, part: Column) -> Column:
        chance = (F.pmod(F.xxhash64(F.lit(seed), F.col("low"), F.col("high"), part["place"]), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        got = hypergeometric(state["total"], part["n"], state["draws"], chance)
        return F.struct(
            (state["total"] - part["n"]).alias("total"),
            (state["draws"] - got).alias("draws"),
            F.concat(state["out"], F.array(got)).alias("out"),
        )

    drawn = nodes.withColumn("draws", draws).withColumn("left", F.aggregate("counts", start, draw)["out"])
    left = F.zip_with("counts", "left", lambda c, n: F.struct(c["place"].alias("place"), n.alias("n")))
    right = F.zip_with("counts", "left", lambda c, n: F.struct(c["place"].alias("place"), (c["n"] - n).alias("n")))
    leaf = F.array(F.struct("low", "high", "counts"))
    halves = F.array(
        F.struct(F.col("low"), F.col("middle").alias("high"), left.alias("counts")),
        F.struct(F.col("middle").alias("low"), F.col("high"), right.alias("counts")),
    )
    return drawn.select(F.inline(F.when(F.col("high") - F.col("low") < 2, leaf).otherwise(halves)))


def hypergeometric(total: Column, marked: Column, draws: Column, chance: Column) -> Column:
    """Marked among ``draws`` of ``total``, by inversion over eight deviations around the mode.

    Ratios of neighbouring probabilities are summed twice as plain numbers: at
    eight deviations they stay within e^40 of each other.
    """
    n, k, d = (c.cast("double") for c in (total, marked, draws))
    low = F.greatest(F.lit(0), draws + marked - total)
    high = F.least(draws, marked)
    mode = F.floor((d + 1) * (k + 1) / (n + 2)).cast("long")
    spread = F.sqrt(F.greatest(d * k / F.greatest(n, F.lit(1.0)) * (1 - k / F.greatest(n, F.lit(1.0))) * (n - d) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.0)))
    reach = (F.ceil(spread * 8) + 2).cast("long")
    first, last = F.greatest(low, mode - reach), F.greatest(low, F.least(high, mode + reach))
    values = F.sequence(first, last)

    def following(p: Column, x: Column) -> Column:
        y = x.cast("double")
        return p * (k - y) * (d - y) / ((y + 1) * (n - k - d + y + 1))

    one = F.lit(1.0)
    mass = F.aggregate(
        values,
        F.struct(one.alias("p"), F.lit(0.0).alias("sum")),
        lambda s, x: F.struct(following(s["p"], x).alias("p"), (s["sum"] + s["p"]).alias("sum")),
        lambda s: s["sum"],
    )
    below = F.aggregate(
        values,
        F.struct(one.alias("p"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n"), (mass * chance).alias("goal")),
        lambda s, x: F.struct(
            following(s["p"], x).alias("p"),
            (s["sum"] + s["p"]).alias("sum"),
            (s["n"] + F.when(s["sum"] + s["p"] < s["goal"], 1).otherwise(0)).alias("n"),
            s["goal"].alias("goal"),
        ),
        lambda s: s["n"],
    )
    return F.least(first + below, last)


def shard_ends(split: DataFrame, shards: int) -> DataFrame:
    """``place, ends``: where each shard's stretch of a source's drawn blocks ends, without the last shard."""
    long = split.select("shard", F.inline("counts"))
    run = F.sum("n").over(Window.partitionBy("place").orderBy("shard"))
    ends = F.sort_array(F.collect_list(F.struct("shard", "end")))
    table = long.withColumn("end", run).filter(F.col("shard") < shards - 1).groupBy("place").agg(ends.alias("ends"))
    if shards == 1:
        return long.select("place").distinct().select("place", F.array().cast("array<bigint>").alias("ends"))
    return table.select("place", F.transform("ends", lambda e: e["end"]).alias("ends"))


def mix_rows(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    seed: str = SEED,
    shards: int = SHARDS,
    task_words: int = TASK_WORDS,
) -> DataFrame:
    """``docs`` as the mix takes them, shard by shard in local order: one row per draw, with the columns of ``docs``.

    Quotas, passes, tree and draws are those of :func:`mix_documents` with
    whole documents for blocks; the document in which a source's quota ends is
    cut to the exact word. A source's prefix and each shard's stretch of its
    draws end at a hash, so every row meets a few numbers of its source and
    decides where it stands; its text is shuffled once, to its place in the mix.
    Rows that agree in id, source and size are numbered by a hash of their
    text. Rows without words weigh nothing and are never drawn.
    """
    units = mix_documents(docs, id_column, text_column, source_column, weights, share, passes, shards, None, seed)
    units = materialize(units.withColumnRenamed(id_column, "id"), "mix-rows")
    plan = draw_plan(units, seed)
    sources = docs.select(F.col(source_column).alias("__source")).distinct()
    places = sources.withColumn("__place", F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last())) - 1)
    plan = materialize(places.join(plan, "__place").drop("__place"), "mix-plan")
    facts = units.filter("block = 0").agg(F.max("copy").alias("copies"), F.sum("words").alias("words")).first()

    size = word_count(F.col(text_column))
    sized = docs.withColumn("__size", size).filter("__size > 0")
    copy = F.lit(0)
    if facts["copies"]:
        same = Window.partitionBy(id_column, source_column, "__size").orderBy(F.xxhash64(text_column))
        copy = F.row_number().over(same) - 1
    met = sized.withColumn("__copy", copy).join(plan, F.col(source_column).eqNullSafe(F.col("__source")))
    # Hashes tell types apart: the types are those of the units.
    block = F.lit(0).cast("long")
    met = met.withColumn("__last", in_rank_order(last_draw(seed, id_column, "__size", "__copy", block)))
    part = F.when(F.col("__last") < F.col("__end.last"), F.col("__size")).when(F.col("__last") == F.col("__end.last"), F.col("__end.words"))

    def take(p: Column) -> Column:
        words = F.when(p <= F.col("__whole"), F.col("__size")).when(p == F.col("__whole") + 1, part)
        draw = in_rank_order(shard_draw(seed, id_column, "__size", "__copy", block, p))
        shard = F.get(F.filter("__stretches", lambda e: e["end"] >= draw), F.lit(0))["shard"]
        order = local_order(seed, id_column, "__size", "__copy", block, p)
        return F.struct(F.coalesce(words, F.lit(0)).alias("words"), shard.alias("shard"), order.alias("order"))

    takes = F.filter(F.transform(F.sequence(F.lit(1), F.lit(passes)), take), lambda t: t["words"] > 0)
    drawn = met.withColumn("__take", F.explode(takes))
    # A split before each word's end keeps what stands between the words.
    cut = F.array_join(F.slice(F.split(text_column, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), 1, F.col("__take.words").cast("int")), "")
    text = F.when(F.col("__take.words") < F.col("__size"), cut).otherwise(F.col(text_column))
    # A shard is dealt over stretches of its local order.
    pieces = max(1, math.ceil((facts["words"] or 0) / task_words / shards))
    piece = F.floor((F.shiftrightunsigned(in_rank_order(F.col("__take.order")), 12) / float(1 << 52)) * pieces)
    at = (F.col("__take.shard") * pieces + F.least(piece, F.lit(pieces - 1))).cast("int")
    columns = [text.alias(c) if c == text_column else F.col(c) for c in docs.columns]
    rows = drawn.select(*columns, F.col("__take.order").alias("__order"), at.alias("__at"))
    return rows.repartitionById(shards * pieces, "__at").sortWithinPartitions("__at", "__order").select(*docs.columns)


def draw_plan(units: DataFrame, seed: str) -> DataFrame:
    """``__place, __whole, __end, __stretches`` per source, from the units of :func:`mix_documents` over whole documents.

    ``__whole`` counts the passes that take everything, ``__end`` is the last
    hash of the prefix with the words taken there, ``__stretches`` are the last
    hashes of the shards' draws.
    """
    drawn = units.filter("pass IS NOT NULL").withColumn("whole", F.floor(F.round("target") / F.col("source_size")))
    last = F.struct(in_rank_order(last_draw(seed, "id", "size", "copy", "block")).alias("last"), "words")
    ends = drawn.groupBy("place").agg(
        F.max("whole").alias("__whole"), F.max(F.when(F.col("pass") > F.col("whole"), last)).alias("__end")
    )
    draw = in_rank_order(shard_draw(seed, "id", "size", "copy", "block", "pass"))
    stretches = drawn.groupBy("place", "shard").agg(F.max(draw).alias("end"))
    stretches = stretches.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("__stretches"))
    return ends.join(stretches, "place").withColumnRenamed("place", "__place")
