"""Prefix trie, structure repair and nearest neighbours against brute force, with skewed, odd and empty tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import neighbours, prefix_trie, repair

TURNS = "conv_id long, turn long, role string, text string, place int, depth int, block string, `h1` string, copy int"
EMPTY = hashlib.sha256(b"").hexdigest()


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "b", "h", 3) for r in rows], TURNS).repartition(5)


def by_digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


# ---- prefix trie


def trie_of(rows):
    turns, nodes, ends, below = {}, {}, {}, {}
    for c, t, r, x in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, by_digest(r or "", x or ""), r or "", x or ""))
    turns = {c: [r[3:] for r in sorted(own)] for c, own in turns.items()}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    for k in nodes:
        if k:
            below.setdefault(k[:-1], []).append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(nodes, key=len, reverse=True):
        under, members = below.get(k, []), nodes[k]
        leaves[k] = sum(leaves[u] for u in under) if under else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        saved[k] = (len(members) - 1) * words + sum(saved[u] for u in under)
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()
        parent = min(nodes[k[:-1]]) if k else None
        out.append((min(members), len(k), parent, len(members), len(under), leaves[k], saved[k], digest))
    return sorted(out, key=str)


def odd_turns(seed, rows, long_id):
    rnd = random.Random(seed)
    for i in range(rows):
        c = rnd.choice([None, *range(-25, 60), *[long_id] * 8])
        # A conversation with many turns of its own, and many of few turns that begin alike.
        turn = i if c == long_id else rnd.choice([None, *range(9)])
        yield c, turn, rnd.choice(["u", "a", None]), rnd.choice([None, "", "x  y", "z", "\U0001f600 é"])


@pytest.mark.parametrize("options", [{}, {"heavy": 3, "cut": 4}])
def test_trie_against_brute_force(spark, options):
    rows = list(odd_turns(3, 900, 7))
    got = prefix_trie.prefix_trie(table_of(spark, rows), **options).collect()
    assert sorted((tuple(r) for r in got), key=str) == trie_of(rows)


def test_trie_of_one_text_in_all_conversations(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(5)]
    got = prefix_trie.prefix_trie(table_of(spark, rows), heavy=16).collect()
    assert sorted((tuple(r) for r in got), key=str) == trie_of(rows)
    assert len(got) == 6 and max(r["n_convs"] for r in got) == 400


def test_empty_trie(spark):
    assert prefix_trie.prefix_trie(table_of(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(table_of(spark, [(None, 1, "user", "x")])).collect() == []


def test_node_table_is_minimal_and_verified():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 2)).astype(np.uint64)
    table = prefix_trie.NodeTable(keys)
    assert sorted(table.slots.tolist()) == list(range(5000))
    assert (table.find(keys) == table.slots).all() and (table.find(keys + np.uint64(1)) == -1).all()


def test_pieces_of_a_conversation_join():
    turns = [int.from_bytes(hashlib.md5(bytes([i])).digest(), "big") for i in range(9)]

    def digest(part, start):
        for t in part:
            start = (start * prefix_trie.BASE + t) % prefix_trie.PRIME
        return start

    whole = digest(turns, prefix_trie.ROOT)
    assert prefix_trie.joined(digest(turns[:4], prefix_trie.ROOT), 5, digest(turns[4:], 0)) == whole


# ---- structure repair


def repairs_of(rows):
    kept = {}
    for c, t, r, x in rows:
        kept.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        r = "user" if kind == 4 else r
        kept[c] += [(t, r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: cheapest(sorted(own, key=lambda a: (a[0] is not None, a[0] or 0, by_digest(a[1], a[2])))) for c, own in kept.items()}


def cheapest(rows):
    """Plain search from the last row to the first: least (cost, audit) of every row and state."""
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", EMPTY)
    blanks, seen, faults = " \t\n\x0b\x0c\r", set(), []
    for _, role, text in rows:
        body = text.strip(blanks)
        faults.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
        seen.add((role, text))
    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names, never = {"u": "user", "a": "assistant"}, (10**9, "", [])
    best = [(0, "", []), never, never, (0, "", [])]
    for i in range(len(rows), -1, -1):
        if i < len(rows):
            (_, role, text), fault, after, best = rows[i], faults[i], best, []
            more = 3 if fault == 3 else 0
            for state in range(4):
                ways = [(after[state][0] + 4, "D" + after[state][1], after[state][2])]
                for letter, name, cost in (("K", role[:1], more), ("R", "u", 3 + more), ("R", "a", 3 + more)):
                    if fault not in (1, 2) and (state, name) in steps:
                        rest = after[steps[state, name]]
                        line = f"{role if letter == 'K' else names[name]}:{text}"
                        ways.append((rest[0] + cost, letter + rest[1], [line, *rest[2]]))
                best.append(min(ways))
        for _ in range(4):
            for state in range(4):
                for name in "ua":
                    if (state, name) in steps:
                        rest = best[steps[state, name]]
                        best[state] = min(best[state], (rest[0] + 3, "I" + rest[1], [f"{names[name]}:", *rest[2]]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = best[0]
    return (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def odd_rows(seed, rows):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    for i in range(rows):
        texts = [None, "", " ", "a.", "c", f"hi {rnd.randrange(90)}.", f"b {rnd.randrange(90)}", f"é {i}?\n", "x " * 5000]
        yield rnd.choice([None, 1, 2, 2, 2, 2, *range(40, 90)]), rnd.choice([None, *range(300)]), rnd.choice(roles), rnd.choice(texts)


@pytest.mark.parametrize("block_rows", [5, repair.BLOCK_ROWS])
def test_repair_against_brute_force(spark, block_rows):
    rows = list(odd_rows(5, 700))
    got = {r[0]: tuple(r[1:]) for r in repair.repair(table_of(spark, rows), block_rows).collect()}
    assert got == repairs_of(rows)


def test_repair_of_repeated_rows_and_nothing(spark):
    rows = [(3, 1, "user", "same."), *[(3, 2, "user", "again.")] * 300]
    got = repair.repair(table_of(spark, rows)).collect()
    assert [tuple(r[1:]) for r in got] == [repairs_of(rows)[3]]
    assert repair.repair(table_of(spark, [])).collect() == []
    dropped = next(c for c in range(999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert [tuple(r) for r in repair.repair(table_of(spark, [(dropped, 0, "user", "x")])).collect()] == [(dropped, 0, 0, 0, 0, 0, 0, "", EMPTY)]


def test_repair_leaves_sound_conversations(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "q?"), (1, 2, "assistant", "r."), (2, 0, "user", "q?"), (2, 1, "assistant", "r")]
    got = {r["conv_id"]: (r["cost"], r["audit"]) for r in repair.repair(table_of(spark, rows), damaged=True).collect()}
    assert got == {1: (0, "KKK"), 2: (3, "KK")}


def test_auction_prices_are_shortest_distances():
    rnd = random.Random(2)
    for _ in range(60):
        rows = [(rnd.choice("suat"), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(rnd.randrange(12))]
        costs, one = repair.costs_between(rows), repair.Auction(rows, [0, repair.NEVER, repair.NEVER, 0])
        for state in range(4):
            assert one.cost(state) == min(costs[4 * state], costs[4 * state + 3])


# ---- nearest neighbours

VECTORS = "vec_id long, embedding array<float>, id long, vector string, ids int, h int, block int, score double"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "v", 2, 3, 4, 0.5) for i, v in rows], VECTORS).repartition(4)


def exact(rows, k, every):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    ok = [(i, v) for i, v in ok if np.isfinite(v).all() and v.any()]
    out = {}
    for q in {i for i, _ in ok if i % every == 0}:
        near = {}
        for i, v in ok:
            if i != q:
                near[i] = min([near.get(i, math.inf), *(float(np.sqrt(np.square(v - w).sum())) for j, w in ok if j == q)])
        out[q] = sorted((s, i) for i, s in near.items())[:k]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return out


def test_neighbours_of_few_and_odd_vectors(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, rnd.normal(size=3).tolist()) for i in range(9)]
    rows += [(20, None), (21, []), (22, [0.0, 0.0, 0.0]), (23, [1.0, None, 2.0]), (24, [math.nan, 1.0, 1.0]), (25, [math.inf, 1.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (30, rows[3][1]), (30, rows[3][1]), (40, rows[4][1]), (40, [5.0, 5.0, 5.0])]
    got = lists(neighbours.nearest(vectors_of(spark, rows), is_query=F.col("vec_id") % 5 == 0, k=4))
    want = exact([(i, [np.float32(x).item() for x in v] if v and None not in v else v) for i, v in rows], 4, 5)
    assert got == want
    all_found = lists(neighbours.nearest(vectors_of(spark, rows), is_query=F.col("vec_id") == 0, k=50))
    assert len(all_found[0]) == len({i for i, _ in rows if i is not None and (i < 20 or i in (30, 40))}) - 1
    assert neighbours.nearest(vectors_of(spark, []), is_query=F.col("vec_id") == 0).collect() == []
    assert neighbours.nearest(vectors_of(spark, rows), is_query=F.col("vec_id") == -1).collect() == []


def test_neighbours_of_one_common_vector(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) if i % 3 else (i, rnd.normal(size=4).tolist()) for i in range(600)]
    got = lists(neighbours.nearest(vectors_of(spark, rows), is_query=F.col("vec_id") % 50 == 0, k=10))
    want = exact([(i, [np.float32(x).item() for x in v]) for i, v in rows], 10, 50)
    common = [q for q in want if q % 3]
    assert common and all(got[q] == want[q] for q in common)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_recall_on_the_test_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = lists(neighbours.nearest(vectors, is_query=F.col("vec_id") % 100 == 0, k=10))
    want = exact([(r["vec_id"], r["embedding"]) for r in vectors.collect()], 10, 100)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert set(got) == set(want) and hits >= 0.95 * sum(map(len, want.values()))
    scores = {(q, i): s for q, near in want.items() for s, i in near}
    assert all(s == scores[q, i] for q, near in got.items() for s, i in near if (q, i) in scores)


@pytest.mark.parametrize("bits", [64, 20, 8, 3])
def test_probing_finds_every_code_within_the_radius(bits):
    rnd = np.random.default_rng(bits)
    plain = rnd.integers(0, 2, (3000, bits)).astype(np.uint8)
    codes = np.pad(np.packbits(plain, axis=1), ((0, 0), (0, 8 - -(-bits // 8))))
    index = neighbours.SubstringIndex(codes, -(-bits // 8))
    for query in range(5):
        apart = (plain != plain[query]).sum(axis=1)
        for radius in (0, 1, 7, 8, 17, bits):
            assert index.within(codes[query], radius).tolist() == np.flatnonzero(apart <= radius).tolist()
