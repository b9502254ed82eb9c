"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every operator."""

import pytest

from corpusloom.llm import (
    decontamination,
    mixing,
    repetition,
    secrets,
    sharding,
    simhash,
    substrings,
    templates,
    token_counts,
    toxicity,
)

SCHEMA = (
    "doc_id bigint, text string, source string, size int, `group` string, shard int, rank int, h int, id string, "
    "words int, chunk int, fingerprint string, spans int, kept int, score int, place int, block int, host string"
)
CLASH = (7, "g", 1, 2, 3, "i", 4, 5, "f", 6, 8, 9, 10, 11, "x.y")
TEXTS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n", None),
    (None, "one two three four five", "b"),
    (None, "one two three four five", "b"),
    (4, "lorem ipsum dolor " * 20_000, "a"),
    (5, "same text of a repeated row", None),
    (5, "same text of a repeated row", None),
    (6, "\U0001f600 ünïcode  words here", "c"),
]
MODEL = toxicity.Model({"lorem": 2.0, "^same": -1.0}, -1.0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*row, *CLASH) for row in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, None), (2, ""), (3, "short item"), (4, "lorem ipsum dolor " * 6), (4, "lorem ipsum dolor " * 6)]
    return spark.createDataFrame(rows, "item_id bigint, text string")


PER_ROW = {
    "sharding": lambda d: sharding.shard_documents(d, shards=3),
    "substrings": substrings.remove_repeats,
    "toxicity": lambda d: toxicity.score_texts(d, MODEL),
    "simhash": simhash.near_duplicates,
    "secrets": secrets.scan_spans,
    "repetition": repetition.quality_rules,
}


@pytest.mark.parametrize("name", list(PER_ROW))
def test_one_row_per_row(docs, name):
    rows = PER_ROW[name](docs).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(t[0]) for t in TEXTS)


@pytest.mark.parametrize("name", list(PER_ROW))
def test_empty_table(docs, name):
    empty = PER_ROW[name](docs.filter("false"))
    assert empty.collect() == []
    assert "doc_id" in empty.columns


def test_mixing_edges(docs):
    for table in (docs, docs.filter("false")):
        rows = mixing.mix_documents(table, shards=3, block_words=7).collect()
        taken = {}
        for r in rows:
            key = (r["doc_id"], r["place"], r["copy"], r["size"])
            taken[key] = taken.get(key, 0) + r["words"]
        assert len(taken) == table.count()
        assert all(n <= 2 * key[3] for key, n in taken.items())
        assert mixing.mix_rows(table).columns == docs.columns


def test_mix_rows_keeps_columns(docs):
    got = mixing.mix_rows(docs).collect()
    assert all(tuple(r)[3:] == CLASH for r in got)
    assert all(r["text"].strip() for r in got)


def test_near_duplicates_keep_one(docs):
    kept = simhash.keep_first(docs).collect()
    # Texts without words are one class, equal texts another each.
    assert len(kept) == 5
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "4", "5", "6", "None"]


def test_decontamination_edges(docs, items):
    found = decontamination.find_items(docs, items).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in found} == {(4, 4, 0)}
    assert len(found) == 2
    assert decontamination.find_items(docs.filter("false"), items).count() == 0
    assert decontamination.find_items(docs, items.filter("false")).count() == 0
    flagged = decontamination.flag_documents(docs, items)
    assert [r["doc_id"] for r in flagged.filter("contaminated").collect()] == [4]
    assert flagged.count() == len(TEXTS)


def test_token_count_edges(spark, docs, tmp_path):
    path = str(tmp_path / "tokens")
    token_counts.write_token_files(docs, path, block_tokens=1000)
    counts = token_counts.count_tokens(token_counts.read_token_blocks(spark, path))
    ids = token_counts.read_document_ids(spark, path)
    rows = ids.join(counts, ["file", "ordinal"]).collect()
    assert len(rows) == counts.count() == len(TEXTS)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    empty = str(tmp_path / "none")
    token_counts.write_token_files(docs.filter("false"), empty)
    assert token_counts.count_tokens(token_counts.read_token_blocks(spark, empty)).count() == 0


def test_page_edges(spark):
    rows = [(1, None, None, "x"), (2, "no url", "", "x"), (3, "http://a.b/c", "<p>t", "x"), (3, "http://a.b/c", "<p>t", "x")]
    rows += [(None, "http://a.b/d", "<p>" + "word " * 50_000, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    got = sorted((str(r["page_id"]), r["n_chars"]) for r in templates.main_text(pages).collect())
    assert got == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("None", 249_999)]
    assert templates.main_text(pages.filter("false")).collect() == []


def test_training_edges(spark, docs):
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 0), (2, 1), (99, 1)], "doc_id bigint, toxic int")
    sample = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", 10)
    assert [(r["text"], r["label"]) for r in sample.collect()] in ([("", 1)], [])
    model = toxicity.fit(sample)
    assert 0 <= model.score(None) <= 1
    assert toxicity.fit(sample.filter("false")).score("any") == pytest.approx(0.5)
