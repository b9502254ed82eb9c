"""Text operators against plain versions of what they compute."""

import random
import re

import pyarrow as pa
import pytest

from corpusloom.llm import decontamination, repetition, secrets, toxicity
from corpusloom.llm.texts import byte_slices, words_of
from corpusloom.llm.vocabulary import encoding, read_ranks


def test_slices_hold_every_row_once():
    batch = pa.record_batch({"id": list(range(6)), "text": ["a" * 10, None, "b" * 50, "", "c", "d" * 9]})
    parts = list(byte_slices(batch, "text", 12))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(6))
    assert all(p.num_rows for p in parts)


@pytest.mark.parametrize("text", ["a b c", "x\x1cy\x0bz", " \r\n", " é\tü"])
def test_words_split_on_six_bytes_only(text):
    assert [w.decode() for w in words_of(text.encode())] == re.findall(r"[^\x20\x09-\x0D]+", text)


# Secrets


@pytest.fixture(scope="module")
def find():
    return secrets.finder(read_ranks(), secrets.MOST_CHARS_PER_TOKEN)


def plain_base(text):
    assign = re.finditer(secrets.ASSIGN, text, re.I | re.A)
    out = [(*m.span(), 0) for m in assign if len(m[2]) >= 6]
    out += [(*m.span(), 1) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(*m.span(), 2) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_match_plain_search(find):
    rng = random.Random(3)
    bits = ["token", "Secret", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "12345678", "AKIA", "ABCDEFGH01234567", "deadbeef", "\U0001f600", "ſecret", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        assert [s for s in find(text) if s[2] < 3] == plain_base(text)


def test_random_strings_and_identifiers(find):
    key = "q8Zr2mVx7LpT0wKd9sYh3Nc5Jb"
    assert [s[2] for s in find(f"\U0001f600 see {key} there")] == [3]
    assert find(f"\U0001f600 see {key} there")[0][:2] == (6, 6 + len(key))
    for plain in (
        "D41D8CD98F00B204E9800998ECF8427E",
        "123e4567-e89b-12d3-a456-426614174000",
        "internationalization_of_things",
        "4111111111111111-1111",
        "section_12-part_3-version_4",
    ):
        assert find(f"an {plain} here") == []


def test_identifier_pattern_is_not_quadratic(find):
    assert find("a1-" * 200_000 + "é") == []


# Repetition


def plain_longest(words):
    n, out = len(words), []
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def test_repeats_match_plain_search():
    rng = random.Random(5)
    for _ in range(120):
        texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(4)]
        got = repetition.measure([t.encode() for t in texts], repetition.Limits(least_words=4))
        for k, text in enumerate(texts):
            words = text.split()
            longest = plain_longest(words)
            covered = {j for i, n in enumerate(longest) if n >= 4 for j in range(i, i + n)}
            windows = {j for i, n in enumerate(longest) if n >= 3 for j in range(i, i + 3)}
            assert got["n_repeat_words"][k] == len(windows)
            assert got["covered_words"][k] == len(covered)
            assert got["longest_repeat"][k] == max([n for n in longest if n >= 4], default=0)


def test_repetition_counts():
    text = "Añ b c #$x\n\nline one\nline one\n  \n"
    got = repetition.measure([text.encode(), None], repetition.Limits())
    assert got["n_words"].tolist() == [7, 0]
    assert got["word_chars"].tolist() == [sum(len(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)), 0]
    assert got["n_symbols"].tolist() == [2, 0]
    assert got["n_dup_lines"].tolist() == [1, 0]
    assert got["kept"].tolist() == [False, False]


def test_long_repeat_is_rejected():
    words = [f"w{i}" for i in range(600)]
    clean, twice = " ".join(words), " ".join(words + words[:120])
    assert repetition.measure([clean.encode(), twice.encode()], repetition.Limits())["kept"].tolist() == [True, False]


# Decontamination


def plain_distance(pattern, text):
    """Least edit distance of the pattern to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        prev, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (c != d)))
    return min(row)


def test_myers_matches_plain_distance():
    rng = random.Random(7)
    for _ in range(300):
        pattern = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 120)))
        got, end = decontamination.myers(decontamination.bit_masks(pattern), len(pattern), text)
        assert got == plain_distance(pattern, text)
        assert plain_distance(pattern, text[:end]) == got


def test_edited_items_are_found_within_budget():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    items = [decontamination.Item(n, t, int(0.05 * len(t))) for n in range(20) for t in [" ".join(rng.sample(vocabulary, 30))]]
    search = decontamination.Searcher(items)
    for turn in range(200):
        item = rng.choice(items)
        body = list(item.text)
        for _ in range(rng.randrange(0, 2 * item.budget)):
            at = rng.randrange(len(body))
            body[at : at + 1] = rng.choice([[], ["x"], [body[at], "y"]])
        around = [" ".join(rng.sample(vocabulary, rng.randrange(0, 40))) for _ in range(2)]
        text = f"{around[0]}  {''.join(body).upper()}\n{around[1]}"
        clean = decontamination.normal(text)
        want = {i.item_id: d for i in items if (d := plain_distance(i.text, clean)) <= i.budget} if turn < 40 else None
        got = {m[0]: m[1] for m in search(text)}
        if want is not None:
            assert got == want
        elif plain_distance(item.text, clean) <= item.budget:
            assert item.item_id in got


def test_short_items_are_found_inside_texts(spark):
    items = ["cat", "what is the capital of france", "extraordinarily complicated questions"]
    texts = [
        "Concatenate cats, scat!",
        "a cat",
        "So: what is THE capital of France? Paris.",
        "pre what is the capitol of france post",
        "what is the capitol of frances",
        "xx extraordinarly complicated questions yy",
        "cat",
    ]
    rows = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = {}
    for d, text in enumerate(texts):
        w = decontamination.normal(text).split()
        runs = [(" ".join(w[i:j]), i, j - i) for i in range(len(w)) for j in range(i + 1, len(w) + 1)]
        for n, item in enumerate(items):
            whole = lambda t: plain_distance(f"<{item}>", f"<{t}>")  # noqa: B023, E731
            distance, first, count = min((whole(t), i, k) for t, i, k in runs)
            if distance <= int(decontamination.ERROR_RATE * len(item)):
                want[d, n] = (distance, first, count)
    assert len(want) == 5
    found = decontamination.find_items(docs, rows).collect()
    assert {(r["doc_id"], r["item_id"]): (r["distance"], r["first_word"], r["n_words"]) for r in found} == want
    flagged = decontamination.flag_documents(docs, rows).filter("contaminated").collect()
    assert {r["doc_id"] for r in flagged} == {d for d, _ in want}


def test_place_is_given_in_words():
    text = "one two three four five six seven eight nine ten"
    search = decontamination.Searcher([decontamination.Item(1, text, 2)])
    assert search("alpha beta, " + text.upper() + "! gamma") == [(1, 0, 2, 10)]


# Toxicity


def test_counterfactual_term_evens_out_groups():
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        words = [rng.choice(["tree", "house", "river", "cloud"]) for _ in range(4)]
        words += ["vile"] * (toxic and rng.random() < 0.8) + (["muslim"] if rng.random() < (0.6 if toxic else 0.05) else [])
        texts.append(sorted(set(words)))
        labels.append(float(toxic))
    import numpy as np

    free = toxicity.fit_words(texts, np.array(labels), toxicity.Training(counterfactual=0.0))
    even = toxicity.fit_words(texts, np.array(labels), toxicity.Training(counterfactual=10.0))
    gap = lambda m: m.score("a muslim by the river") - m.score("a jewish by the river")
    assert gap(free) > 0.2
    assert abs(gap(even)) < 0.05
    assert even.score("vile river") > 0.6 > even.score("muslim river")


def test_held_out_labels_are_not_learnt(spark):
    import zlib

    docs = spark.createDataFrame([(i, f"t{i}") for i in range(40)], "doc_id bigint, text string")
    labels = docs.selectExpr("doc_id", "1 AS toxic")
    texts = {r["text"] for r in toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", 100).collect()}
    assert texts == {f"t{i}" for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2}
    out = {r[0] for r in docs.filter(toxicity.held_out("doc_id")).select("text").collect()}
    assert not out & texts and len(out | texts) == 40


def test_vocabulary_round_trip():
    tokens = encoding(read_ranks())
    text = "Some text, with números 123 and \U0001f600"
    assert tokens.decode(tokens.encode_ordinary(text)) == text
