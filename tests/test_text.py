import random
from collections import Counter

import pytest
import regex
from conftest import plan_of
from pyspark.sql import functions as F

from corpusloom.functions import markup, text as tx
from corpusloom.operators import chunking


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "t string").select(build(F.col("t"))).head()[0]


SECTIONS = [
    (
        "intro a b\n## H one\naa bb cc\n## H two\ndd ee\n## Big\n1 2 3 4 5 6 7 8 9 10 11 12",
        ["intro a b\nH one\naa bb cc", "H two\ndd ee", "Big\n1 2 3 4 5 6 7 8 9 10 11 12"],
    ),
    ("## Big\n1 2 3 4 5 6 7 8 9 10 11 12\n## s\nx", ["Big\n1 2 3 4 5 6 7 8 9 10 11 12", "s\nx"]),
    ("", []),
    (None, None),
    ("a b c d e\n## f\ng h i j", ["a b c d e\nf\ng h i j"]),
    ("a b c d e\n## f\ng h i j k", ["a b c d e", "f\ng h i j k"]),
    ("p q\n```\n## no\n```\n## yes\nr s t u v w", ["p q\n```\n## no\n```", "yes\nr s t u v w"]),
    ("~~~\n## in\n~~~\nx\n## out\ny", ["~~~\n## in\n~~~\nx", "out\ny"]),
    ("## empty\n## full\nz", ["full\nz"]),
]


@pytest.mark.parametrize("text,chunks", SECTIONS)
def test_merge_sections(spark, text, chunks):
    assert one(spark, text, lambda c: tx.merge_sections(c, 20)) == chunks


def test_custom_counter(spark):
    words_only = lambda c: F.size(F.split(F.trim(c), r"\s+"))
    assert one(spark, "a\n## b\nc", lambda c: tx.merge_sections(c, 20, words_only)) == ["a\nb\nc"]


def test_images_are_removed(spark):
    text = "before ![x](data:image/png;base64,iVBORw0KGgo=\nAAAA) after"
    assert one(spark, text, tx.strip_data_images) == "before ![x]() after"


def test_minimum_is_strict(spark):
    df = spark.createDataFrame([(1, " ".join("w" * 20)), (2, " ".join("w" * 21)), (3, None), (4, "")], "id int, t string")
    assert [r["id"] for r in chunking.chunk_documents(df, "t", ["id"]).collect()] == [2]


def test_chunking_stays_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "x")], "id int, t string")
    plan = plan_of(chunking.chunk_documents(df, "t", ["id"]))
    assert "Python" not in plan and "Exchange" not in plan


PIECES = ["a", "bb", "ccc", ". ", ", ", " ", "\n", "\n\n", "é", "x-y", "?!"]


def test_windows_cover_the_text(spark):
    rng = random.Random(5)
    texts = ["", ". ", "\n\n"] + ["".join(rng.choices(PIECES, k=rng.randrange(1, 120))) for _ in range(150)]
    size, overlap = 10, 2
    rows = (
        spark.createDataFrame([(t,) for t in texts], "t string")
        .select(
            tx.tokens(F.col("t")).alias("toks"),
            tx.counted_token_windows(F.col("t"), size, overlap).alias("plain"),
            tx.counted_boundary_windows(F.col("t"), size, overlap).alias("snapped"),
            tx.sentence_windows(F.col("t"), size, overlap).alias("packed"),
        )
        .collect()
    )
    for row in rows:
        for windows in (row["plain"], row["snapped"]):
            assert all(0 < w["n_tokens"] <= size for w in windows)
            # Dropping the overlap from all windows but the first gives the text back.
            rebuilt = []
            for w in windows:
                mine = regex.findall(tx.TOKEN, w["content"])
                assert len(mine) == w["n_tokens"]
                rebuilt += mine[overlap:] if rebuilt else mine
            assert rebuilt == row["toks"]
        packed = [regex.findall(tx.TOKEN, c) for c in row["packed"]]
        assert all(0 < len(c) <= size for c in packed)
        # Nothing is lost: every run of the text stands in some chunk, in order.
        assert not Counter(row["toks"]) - Counter(t for c in packed for t in c)


def test_boundaries_are_preferred(spark):
    text = "one two three four five six.\n\nseven eight nine ten eleven twelve"
    # Eight tokens would cut after 'seven'; the blank line lies in the second half of the window.
    assert one(spark, text, lambda c: tx.boundary_windows(c, 8, 1))[0] == "one two three four five six."


def test_sentences_overlap(spark):
    text = "Aa bb. Cc dd. Ee ff. Gg hh."
    assert one(spark, text, lambda c: tx.sentence_windows(c, 6, 3)) == ["Aa bb. Cc dd.", "Cc dd. Ee ff.", "Ee ff. Gg hh."]


HTML = [
    ("<p>no article</p>", None),
    (None, None),
    ("<article>first</article><article>second</article>", "first"),
    ("<article>&amp;lt; &lt;b&gt; &amp;amp;</article>", "&lt; <b> &amp;"),
    ("<ARTICLE class='x'><h1>T</h1><h3 id=a>S</h3><p>a<br/>b</p><ul><li>i</li></ul></ARTICLE>", "# T\n\n### S\na\nb\n\n- i"),
    ("<article>caf&eacute; &#8217;x&rsquo; &#x1F600; &#xD800;&nosuch; R&D</article>", "café ’x’ \U0001f600 \ufffd&nosuch; R&D"),
    ("<!-- <article>no</article> --><article>a <!-- a > b -->c</article>", "a c"),
    ("<article><p>See <a class=x href='/u?a=1'>this</a>, <b>bold</b> and <em>soft</em></p><code>f(x)</code></article>",
     "See [this](/u?a=1), **bold** and *soft*\n\n`f(x)`"),
    ("<article>\x02 5 <table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table></article>", "\x02 5 \n1 | 2\n3"),
    ("<article>a<script>if (x<y) {}</script><style>p{}</style>b</article>", "ab"),
]


@pytest.mark.parametrize("html,text", HTML)
def test_html(spark, html, text):
    assert one(spark, html, markup.html_to_text) == text
