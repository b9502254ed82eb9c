"""Texts alike in five-word shingles against all pairs."""

import random

import numpy as np
import pytest

from corpusloom.llm import similar_texts


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_links(texts):
    """Pairs of ids at a similarity of 0.8 or more; texts without words have none."""
    sets = {k: s for k, t in texts.items() if (s := shingles(t))}
    holders = {}
    for k, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(k)
    pairs = {}
    for near in holders.values():
        for i, a in enumerate(near):
            for b in near[i + 1 :]:
                pairs[a, b] = pairs.get((a, b), 0) + 1
    return {p for p, n in pairs.items() if n / (len(sets[p[0]]) + len(sets[p[1]]) - n) >= 0.8}


def plain_similar(texts):
    """Ids that stay: of each component of linked texts the smallest."""
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in plain_links(texts):
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {k for k in texts if root[k] == k}


def near_copies(rng, groups, most, length=120):
    """Groups of texts that differ from a base in a few words each."""
    texts = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(500)}" for _ in range(length)]
        for _ in range(rng.randrange(1, most)):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    return dict(enumerate(texts))


def kept(spark, texts, **options):
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    gone = similar_texts.similar_classes(docs, **options).filter("node <> class").select("node")
    rows = docs.withColumn("node", similar_texts.node_column(docs["text"])).join(gone, "node", "left_anti").collect()
    return {r["doc_id"] for r in rows}


@pytest.mark.parametrize("most", [1024, 8])
def test_near_copies_are_one_class(spark, most):
    texts = near_copies(random.Random(most), 12, 40)
    want = plain_similar(texts)
    got = kept(spark, texts, most=most)
    distinct = {k for k in texts if k in want}
    assert len(want) < len(texts) / 3
    # Equal texts stay together here, so compare the texts that stay.
    assert {texts[k] for k in got} >= {texts[k] for k in distinct}
    lost = {texts[k] for k in got} - {texts[k] for k in distinct}
    assert len(lost) <= (0.02 if most == 1024 else 0.05) * len(texts)


def test_a_common_passage_does_not_link(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {k: passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for k in range(300)}
    assert kept(spark, texts, most=16) == set(texts)


def test_pairs_behind_a_common_passage_are_found(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {}
    for k in range(0, 400, 2):
        tail = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        texts[k] = " ".join([passage, *tail])
        texts[k + 1] = " ".join([passage, *tail[:-3], "other", "last", "words"])
    assert len(plain_similar(texts)) == 200
    assert len(kept(spark, texts, most=16)) <= 204


def test_real_documents_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = plain_similar(texts)
    stays = {r["doc_id"] for r in similar_texts.keep_first_similar(docs).collect()}
    removed = set(texts) - want
    assert removed and len(removed - stays) >= 0.98 * len(removed)
    # Fingerprints within two bits may remove a few more.
    assert len(want - stays) <= 0.01 * len(want) + 1


def test_edges(spark):
    schema = "doc_id string, text string, node int, class int, least int, id int, `a.b` int, minima int, grams int"
    rest = (1, 2, 3, 4, 5, 6, 7)
    long = "many words in one text " * 30_000
    rows = [("a", None), ("b", ""), ("c", " \n"), (None, "x"), (None, "x"), ("d", "X"), ("e", long), ("f", long + "end"), ("g", "y z")]
    docs = spark.createDataFrame([(*r, *rest) for r in rows], schema)
    out = similar_texts.keep_first_similar(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted(r["doc_id"] for r in got) == ["a", "d", "e", "g"]
    assert all(tuple(r)[2:] == rest for r in got)
    assert similar_texts.keep_first_similar(docs.filter("false")).count() == 0
    assert similar_texts.keep_first_similar(docs.filter("text is null")).count() == 1


def test_minima_estimate_similarity():
    rng = np.random.default_rng(1)
    odd, shift = similar_texts._multipliers()
    pool = rng.integers(1 << 62, size=1200, dtype=np.uint64)
    a, b = similar_texts.minima(pool[:1000], odd, shift), similar_texts.minima(pool[200:], odd, shift)
    assert abs((a == b).mean() - 800 / 1200) < 0.15


def banded_similar(texts):
    """Smallest id of each component over the links whose texts agree in a band."""
    odd, shift = similar_texts._multipliers()
    rows = {k: similar_texts.minima(similar_texts.shingle_hashes(t.encode())[1], odd, shift).reshape(similar_texts.BANDS, -1) for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in plain_links(texts):
        if (rows[a] == rows[b]).all(axis=1).any():
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {k for k in texts if root[k] == k}


@pytest.mark.parametrize("most,paired", [(8, 0), (8, 16), (1024, 16)])
def test_no_link_is_lost_to_cut_buckets_or_estimates(spark, most, paired):
    """Chains: only neighbours are alike, so a class falls apart with any link that is not met."""
    rng, texts = random.Random(3), {}
    for g in range(6):
        words = [f"g{g}w{n}" for n in range(150)]
        for n in range(40):
            at = rng.randrange(150)
            words[at : at + 6] = [f"g{g}n{n}x{i}" for i in range(len(words[at : at + 6]))]
            texts[len(texts)] = " ".join(words)
    assert kept(spark, texts, most=most, paired=paired) == banded_similar(texts)


def test_linked_labels_against_all_pairs():
    rng = np.random.default_rng(2)
    base = rng.permutation(60).reshape(4, 15)
    sets = [np.sort(np.r_[rng.choice(b, 13, replace=False), rng.integers(100, 102)]) for b in base for _ in range(6)]
    labels = np.arange(len(sets)) // 2
    want = {(labels[i], labels[j]) for i, a in enumerate(sets) for j, b in enumerate(sets) if len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.8}
    near = {x: {y for a, y in want if a == x} for x in labels}
    sizes = np.array([len(s) for s in sets])
    got = similar_texts.linked_labels(np.concatenate(sets), sizes, labels, np.arange(12), np.arange(len(sets)))
    assert set(zip(*got)) <= want
    root = {x: x for x in labels}
    for a, b in zip(*got):
        old, new = root[a], root[b]
        root = {x: new if r == old else r for x, r in root.items()}
    assert all(root[a] == root[b] for a in labels[:12] for b in near[a])
