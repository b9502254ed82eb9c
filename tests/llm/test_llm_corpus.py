"""Operators over a whole table against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from test_llm_similar import plain_similar

import corpus_pipeline
from corpusloom.llm import decontamination, mixing, sharding, simhash, substrings, templates, token_counts
from corpusloom.llm.vocabulary import encoding, read_ranks


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# Sharding


def test_shards_are_even_and_groups_whole(spark):
    rng = random.Random(1)
    texts = ["hot"] * 400 + [words(rng, 5) for _ in range(500)] + [f"pair {i // 2}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    rows = sharding.shard_documents(docs, shards=7).collect()
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 7
    for s, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    where = defaultdict(Counter)
    for r in rows:
        where[texts[r["doc_id"]]][r["shard"]] += 1
    pairs = [c for t, c in where.items() if t.startswith("pair")]
    assert sum(len(c) == 1 for c in pairs) >= 0.97 * len(pairs)
    # 400 rows need three shards of 171 or 172; cut edges stay near that optimum.
    assert sum(n * n for n in where["hot"].values()) > 0.6 * (2 * 171**2 + 58**2)


def test_texts_that_all_occur_twice_come_together(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, words(rng, 6)) for i in range(1600)], "doc_id bigint, text string")
    rows = sharding.shard_documents(docs.union(docs).repartition(4), shards=8).collect()
    assert Counter(Counter(r["shard"] for r in rows).values()) == {400: 8}
    where = defaultdict(set)
    for r in rows:
        where[r["doc_id"]].add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) <= 8


def test_exchange_moves_no_more_than_leave_or_fit():
    rng = random.Random(3)
    for _ in range(50):
        asks = [[rng.randrange(30) * (s != t) for t in range(6)] for s in range(6)]
        rooms = [rng.choice([0, 0, 5]) for _ in range(6)]
        got = sharding.exchange(asks, rooms)
        assert all(0 <= got[s][t] <= asks[s][t] for s in range(6) for t in range(6))
        for t in range(6):
            assert sum(got[s][t] for s in range(6)) - sum(got[t]) <= rooms[t]
    assert sharding.exchange([[0, 4, 0], [0, 0, 3], [9, 0, 0]], [0, 0, 0]) == [[0, 3, 0], [0, 0, 3], [3, 0, 0]]


def test_more_shards_than_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "doc_id bigint, text string")
    rows = sharding.shard_documents(docs, shards=16).collect()
    assert len({r["shard"] for r in rows}) == 3 and {r["slot"] for r in rows} == {0}


# Mixing


def plain_targets(sizes, weights, share, passes):
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total, full = share * sum(sizes), set()
    while True:
        rest = total - sum(passes * sizes[i] for i in full)
        open_w = sum(w[i] for i in range(len(sizes)) if i not in full)
        over = {i for i in range(len(sizes)) if i not in full and rest * w[i] / open_w > passes * sizes[i]}
        if not over:
            return [passes * sizes[i] if i in full else rest * w[i] / open_w for i in range(len(sizes))]
        full |= over


@pytest.mark.parametrize("seed", range(6))
def test_targets_match_plain_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 5, 50, 500, 5000]) for _ in range(9)] + [7]
    rows = [(f"s{i}" if i < 9 else None, n) for i, n in enumerate(sizes)]
    got = mixing.source_targets(spark.createDataFrame(rows, "source string, source_size bigint"))
    table = {r["source"]: r["target"] for r in got.collect()}
    want = plain_targets(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.PASSES)
    assert [table[s] for s, _ in rows] == pytest.approx(want)


def test_mix_meets_targets_and_repeats(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "b", "b", None]), words(rng, rng.randrange(0, 90))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    runs = [mixing.mix_documents(d, shards=5, block_words=16).collect() for d in (docs, docs.repartition(7))]
    assert sorted(map(str, runs[0])) == sorted(map(str, runs[1]))
    taken, target, size = Counter(), {}, {}
    for r in runs[0]:
        taken[r["place"]] += r["words"]
        target[r["place"]] = r["target"]
    assert all(abs(taken[p] - target[p]) <= 1 for p in target)
    per_doc = Counter()
    for r in runs[0]:
        per_doc[r["doc_id"]] += r["words"]
        size[r["doc_id"]] = r["size"]
    assert all(per_doc[d] <= 2 * n for d, n in size.items()) and len(size) == 600
    shards = Counter(r["shard"] for r in runs[0] if r["pass"])
    assert max(shards.values()) - min(shards.values()) <= 5
    drawn = Counter((r["doc_id"], r["copy"], r["block"], r["pass"]) for r in runs[0] if r["pass"])
    assert max(drawn.values()) == 1
    kept = Counter(r["doc_id"] for r in mixing.mix_rows(docs).collect())
    assert max(kept.values()) <= 2


def test_mix_rows_are_the_draws_of_the_tree(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", "b", "b", None]), " " + words(rng, rng.choice([0, 7, 30, 400])) + "\n") for i in range(200)]
    rows += [(500, "a", words(rng, 3000)), (501, "b", words(rng, 5000))] + rows[:40]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(3)
    units = mixing.mix_documents(docs, shards=5, block_words=None).filter("pass IS NOT NULL").collect()
    mixed = mixing.mix_rows(docs, shards=5, task_words=3000)
    parts = mixed.rdd.glom().collect()
    pieces = len(parts) // 5
    assert pieces > 1
    got, taken = [], Counter()
    for k, part in enumerate(parts):
        for r in part:
            n = len(r["text"].split())
            got.append((k // pieces, r["doc_id"], n))
            taken[r["source"]] += n
    assert sorted(got) == sorted((u["shard"], u["doc_id"], u["words"]) for u in units)
    order = lambda u: (u["shard"], u["order"])
    assert [g[1] for g in got] == [u["doc_id"] for u in sorted(units, key=order)]
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += len(text.split())
    names = ["a", "b", None]
    goals = plain_targets([sizes[s] for s in names], mixing.WEIGHTS, mixing.SHARE, mixing.PASSES)
    assert all(abs(taken[s] - g) <= 0.51 for s, g in zip(names, goals, strict=True))
    texts = defaultdict(list)
    for i, _, text in rows:
        texts[i].append(text)
    assert all(any(t.startswith(r["text"]) for t in texts[r["doc_id"]]) for part in parts for r in part)


def test_tree_splits_exactly_and_without_bias(spark):
    counts = [4000, 900, 100, 0]
    quotas = spark.createDataFrame(list(enumerate(counts)), "place int, blocks bigint")
    halves = []
    for seed in range(60):
        rows = mixing.split_quotas(quotas, 3, f"s{seed}").collect()
        parts = {r["shard"]: [c["n"] for c in r["counts"]] for r in rows}
        assert [sum(p[i] for p in parts.values()) for i in range(4)] == counts
        sums = [sum(p) for p in parts.values()]
        assert max(sums) - min(sums) <= 2
        halves.append(parts[0])
    mean, spread = np.mean(halves, axis=0), np.std(halves, axis=0)
    assert mean[:3] == pytest.approx([4000 / 3, 300, 100 / 3], rel=0.06)
    sd = np.sqrt(1666 * 0.18 * 0.82 * (1 - 1666 / 5000))
    assert 0.6 * sd < spread[1] < 1.5 * sd


# Substrings


def plain_removed(texts, window):
    lists = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return out


@pytest.mark.parametrize("seed", range(5))
def test_repeated_windows_match_plain_search(spark, seed):
    rng = random.Random(seed)
    passages = [words(rng, rng.randrange(20, 60), 50) for _ in range(6)] + ["run " * 90, "ab cd " * 40]
    texts = [None, "", "x"]
    for _ in range(60):
        parts = [words(rng, rng.randrange(0, 50), rng.choice([2, 3, 1000])) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passages))
        texts.append(" ".join(parts))
    texts += texts[5:9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for window, rounds in ((35, substrings.ROUNDS), (12, 4)):
        got = substrings.remove_repeats(docs, window=window, rounds=rounds, chunk_bytes=2000, bucket_bytes=5000).collect()
        rows = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in got}
        assert [rows[i] for i in range(len(texts))] == plain_removed(texts, window)


# SimHash


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(prints, most_bits):
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most_bits:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_and_components_match_brute_force(spark):
    rng = random.Random(9)
    base = [words(rng, rng.choice([1, 2, 3, 40, 200])) for _ in range(60)]
    texts = [None, "", "A b", "a B", "É x y z", "é x y z"] + base
    for t in base[:40]:
        w = t.split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = "edit"
            texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs, sample=32, shard_size=16).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    assert [got[i]["fingerprint"] & (1 << 64) - 1 for i in range(len(texts))] == prints
    assert [got[i]["component_id"] for i in range(len(texts))] == plain_components(prints, 2)
    hexed = docs.sparkSession.createDataFrame([(10,), (-1,)], "f bigint").select(simhash.hex_digits("f")).collect()
    assert [r[0] for r in hexed] == ["000000000000000a", "f" * 16]
    assert {r["doc_id"] for r in simhash.keep_first(docs).collect()} == set(plain_components(prints, 2))


@pytest.mark.parametrize("near", [0, 3, 6])
def test_local_components_on_dense_and_sparse_sets(near, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(near)
    prints = {rng.getrandbits(64) for _ in range(150)}
    center = rng.getrandbits(64)
    while near and len(prints) < 300:
        x = center
        for _ in range(rng.randrange(near + 1)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    members = np.array(sorted(prints), np.uint64)
    assert simhash.local_components(members, 2).tolist() == plain_components([int(m) for m in members], 2)


def test_routing_meets_every_close_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    members = np.unique(np.concatenate([base, base ^ np.uint64(1 << 5), base ^ np.uint64(3 << 20)]))
    tree, shards = simhash.grow(members[::3], 20, 2)
    assert shards > 3
    places = defaultdict(set)
    for shard, at in simhash.route(tree, members, 2):
        for i in at.tolist():
            places[i].add(shard)
    a, b = np.nonzero(np.bitwise_count(members[:, None] ^ members[None, :]) <= 2)
    assert all(places[i] & places[j] for i, j in zip(a.tolist(), b.tolist(), strict=True))


def test_chained_components(spark):
    chain = [(i + 1, i) for i in range(40)] + [(100, 99), (100, 98)]
    stars = spark.createDataFrame(chain, "node bigint, root bigint")
    got = {r["node"]: r["root"] for r in simhash.components(stars).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 99: 98, 100: 98}


# Token files


def test_counts_match_tokenizer(spark, tmp_path):
    rng = random.Random(6)
    texts = [words(rng, rng.choice([0, 1, 5, 300])) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    path = str(tmp_path / "t")
    token_counts.write_token_files(docs, path, block_tokens=64)
    counts = token_counts.count_tokens(token_counts.read_token_blocks(spark, path))
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.read_document_ids(spark, path).join(counts, ["file", "ordinal"]).collect()}
    tokens = encoding(read_ranks())
    assert got == {i: len(tokens.encode_ordinary(t)) for i, t in enumerate(texts)}


@pytest.mark.parametrize("block", [1, 2, 3, 5, 64])
def test_flat_files_are_stitched(spark, tmp_path, block):
    lengths = {"a.bin": [3, 0, 7, 1], "b.bin": [0, 0], "c.bin": [9], "d.bin": []}
    for name, sizes in lengths.items():
        stream = [x for n in sizes for x in [5] * n + [token_counts.END]]
        if name == "c.bin":
            stream += [5, 5]
        (tmp_path / name).write_bytes(np.array(stream, "<u2").tobytes())
    blocks = token_counts.read_flat_files(spark, str(tmp_path), block_tokens=block)
    got = defaultdict(list)
    for r in sorted(token_counts.count_tokens(blocks).collect(), key=lambda r: r["ordinal"]):
        got[r["file"].rpartition("/")[2]].append(r["n_tokens"])
    assert got == {"a.bin": [3, 0, 7, 1], "b.bin": [0, 0], "c.bin": [9, 2]}


# Pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no</p>";</script></head>
<body><header><a href="/">Site</a></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<!-- a > b <p>hidden</p> --><div class="cookie-notice">We use cookies</div>
<div id="wrap"><div class="content">{title}{body}<div class="ad-box">Buy</div><p>Last &amp; end &#8217;x&rsquo; caf&eacute;</p></div>
<div class="sidebar"><p>Side</p></div><section id="comments"><p>I like it</p></section></div>
<form><p>Mail</p><input></form><footer><p>&copy; site</p></footer></body></html>"""


def test_slots_of_the_article(spark):
    rng = random.Random(8)
    rows = []
    for i in range(70):
        paragraphs = [words(rng, rng.randrange(1, 30)) for _ in range(rng.randrange(1, 6))]
        body = "".join(f"<p>{p[:3]}<b>{p[3:6]}</b>\n  {p[6:]}" + ("</p>" if rng.random() < 0.8 else "") for p in paragraphs)
        want = [f"Head {i}", *[" ".join(f"{p[:3]}{p[3:6]} {p[6:]}".split()) for p in paragraphs], "Last & end ’x’ café"]
        rows.append((i, f"http://h{i % 2}.net/{i}", PAGE.format(title=f"<h1>Head {i}</h1>", body=body), "\n\n".join(want)))
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string").repartition(4)
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in templates.main_text(pages, set_pages=8).collect()}
    assert got == {r[0]: (r[3], len(r[3])) for r in rows}


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article><p>a<br>b</article><p>out", "a b"),
        ("<body><ul><li>x<li>y</ul>", "x\n\ny"),
        ("<p>cut <b>off", "cut off"),
        ("<p>1 < 2 & 3</p><p", "1 < 2 & 3"),
        ("<article><header><h1>H</h1></header><p title='a>b'>t</p><aside>no</aside></article>", "H\n\nt"),
        ("plain", "plain"),
        ("<nav>only</nav>", ""),
    ],
)
def test_single_pages(html, text):
    assert templates.extract([html]) == [text]


def test_frame_rejects_changing_order():
    pages = [templates.parse(h)[1] for h in ("<body><main>a</main><section>b</section>", "<body><section>b</section><main>a</main>")]
    assert "/body/main" not in templates.frame(pages)
    assert "/body" in templates.frame(pages[:1])


# Pipeline


def test_pipeline_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert out.columns == docs.columns
        docs = out
        seen.append(docs.collect())
    source, clean, unique, safe, mixed, shards = seen
    assert {r["doc_id"] for r in clean} <= {r["doc_id"] for r in source} and len(clean) > 0.8 * len(source)
    prints = [plain_fingerprint(r["text"]) for r in clean]
    ids = [r["doc_id"] for r in clean]
    order = sorted(range(len(ids)), key=ids.__getitem__)
    stays = plain_similar({r["doc_id"]: r["text"] for r in clean})
    order = [i for i in order if ids[i] in stays]
    first = plain_components([prints[i] for i in order], 2)
    assert sorted(r["doc_id"] for r in unique) == sorted({ids[order[i]] for i in first})
    items = [decontamination.normal(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaks = {r["doc_id"] for r in unique if any(t in decontamination.normal(r["text"]) for t in items)}
    assert not leaks & {r["doc_id"] for r in safe}
    assert len(unique) - len(safe) - len(leaks) <= 1
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in safe}
    size = lambda r: len(r["text"].encode().split())
    assert sum(map(size, mixed)) == pytest.approx(1.5 * sum(map(size, safe)), rel=0.05)
    assert sorted(r["doc_id"] for r in shards) == sorted(r["doc_id"] for r in mixed)
    counts = Counter(r["shard"] for r in shards)
    assert max(counts.values()) - min(counts.values()) <= 1


def test_run_gives_the_last_stage(spark, sf):
    assert "shard" in corpus_pipeline.run(spark, sf).columns
