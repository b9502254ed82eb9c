"""Inputs that once took forever or lost text, other id types, and the draws behind the mix."""

import re
import time

import duckdb
import pytest
from conftest import SF, plan_of

from corpusloom.llm import decontamination, secrets, templates, token_counts
from corpusloom.llm.suite import suite

LONG = 10_000


@pytest.mark.parametrize(
    "start",
    ['<a href="x"' + " " * LONG + '"y">', "<a " + "/" * LONG + '"', "<a " + "x " * LONG + '"', "<p" + " a=b" * LONG + "'>", "<a" + " =" * LONG + '"',
     "<svg " * LONG, "<script " * LONG, "<!--" * LONG, "<a " * LONG, "&" * LONG],
)
def test_pages_are_read_in_one_pass(start):
    begun = time.perf_counter()
    templates.extract([start + "<p>end</p>"] * 2)
    assert time.perf_counter() - begun < 1


@pytest.mark.parametrize("run", ["a" + "-" * LONG + "1a", "a1" * LONG + "!", "a-1" * LONG + "!", "-a_" * LONG, "=" * LONG + "!"])
def test_identifiers_are_read_in_one_pass(run):
    begun = time.perf_counter()
    re.compile(secrets.IDENTIFIER).fullmatch(run)
    assert time.perf_counter() - begun < 1


def test_identifiers_keep_their_meaning():
    pattern = re.compile(secrets.IDENTIFIER)
    for text in ("snake_case_name1-v2", "a--b__c", "Name12", "x=y1", "123-456", "8f14e45f-ceea-167a-5a36-dedd4bea2543"):
        assert pattern.fullmatch(text)
    for text in ("a1b2c3", "x1-2y3z4"):
        assert not pattern.fullmatch(text)


def article(body):
    return f"<html><body><nav>menu</nav><main><article><h1 id='search'>Title</h1>{body}</article></main></body></html>"


def test_articles_keep_sections_formulas_and_what_follows_a_drawing():
    page = article(
        "<p>R&<b>lt;</b> <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p><section id='discussion'><p>one</p></section>"
        "<section class='related work'><p>two</p></section><div class='ad'>buy</div><svg width='1'/><p>after</p>"
        "<svg><text>drawn</text></svg><p>end</p>"
    )
    assert templates.extract([page]) == ["Title\n\nR&lt; x=2\n\none\n\ntwo\n\nafter\n\nend"]


def test_doubtful_elements_go_with_evidence():
    # A box that most pages of the host have, and a list of links.
    pages = [article(f"<p>text {i} of the page</p><div class='related'>read on: number {i}</div>") for i in range(6)]
    assert templates.extract(pages) == [f"Title\n\ntext {i} of the page" for i in range(6)]
    assert templates.extract([article("<p>text</p><div class='related'><a href='/x'>other page</a></div>")]) == ["Title\n\ntext"]


@pytest.mark.parametrize("kind", ["int", "string", "bigint"])
def test_ids_of_other_types(spark, tmp_path, kind):
    html = article("<p>text of the page</p>")
    pages = spark.createDataFrame([(1, "http://a.b/c", html), (None, None, None)], "page_id bigint, url string, html string")
    pages = pages.withColumn("page_id", pages.page_id.cast(kind))
    got = templates.main_text(pages)
    assert got.schema["page_id"].dataType.simpleString() == kind and got.count() == 2
    docs = spark.createDataFrame([(1, "x one two three four five six seven eight nine y")], "doc_id bigint, text string")
    docs = docs.withColumn("doc_id", docs.doc_id.cast(kind))
    items = spark.createDataFrame([(7, "one two three four five six seven eight nine")], "item_id bigint, text string")
    items = items.withColumn("item_id", items.item_id.cast(kind))
    found = decontamination.find_items(docs, items).collect()
    assert [(str(r["doc_id"]), str(r["item_id"])) for r in found] == [("1", "7")]
    path = str(tmp_path / "tokens")
    token_counts.write_token_files(docs, path)
    assert [str(r["doc_id"]) for r in token_counts.read_document_ids(spark, path).collect()] == ["1"]


def test_overlaps_with_many_spans_are_told_in_order():
    find = secrets.finder(secrets.read_ranks(secrets.DEFAULT_PATH), 2.0)
    key = "Zx9Qw3Rt7Yp1Lk5Mn8Bv2"
    text = " ".join(f"token={key}{i} {key}{i}" for i in range(300))
    spans = find(text)
    taken = [s for s in spans if s[2] != 3]
    assert len(taken) == 300
    for start, end, kind in spans:
        assert kind != 3 or not any(a < end and start < b for a, b, _ in taken)
    assert sum(kind == 3 for _, _, kind in spans) == 300


def test_mix_comes_through_its_draws(spark):
    df = suite.queries["op2_mixing"](spark, SF)
    plan = plan_of(df)
    assert "Window" in plan and "bit_xor" in plan and "filter(ends" in plan.replace("Filter", "filter").replace(" ", "")
    rows = df.collect()
    assert all(r["taken"] == sum(r["shard_words"]) for r in rows)
    assert all((r["order_digest"] != 0) == (r["taken"] > 0) for r in rows)
    # Every shard gets as many blocks as any other, so nearly as many words.
    words = [sum(r["shard_words"][i] for r in rows) for i in range(16)]
    sizes = duckdb.sql(f"SELECT sum(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))) FROM '{SF}/documents.parquet'").fetchall()[0][0]
    assert abs(sum(words) - 1.5 * sizes) < 0.02 * sizes
