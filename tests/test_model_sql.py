import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corpusloom.functions import model_sql
from corpusloom.operators import baselines


@pytest.fixture(scope="module")
def functions(spark):
    return model_sql.register_model_functions(
        spark,
        {"echo": lambda texts, form: [f"{t}|{form or ''}" for t in texts], "shout": lambda texts, form: [t.upper() for t in texts]},
        generator="shout",
        lexicon={"good": 1, "bad": -1},
        glossaries={"es": {"hello": "hola", "world": "mundo"}},
        patterns={"store": "Shop [A-Z]"},
    )


def test_all_are_registered(spark, functions):
    assert len(functions) == 10
    assert all(spark.catalog.functionExists(name) for name in functions)


def one(spark, sql):
    return spark.sql(f"SELECT {sql}").head()[0]


def test_query_and_gen(spark, functions):
    assert one(spark, "ai_query('echo', 'a')") == "a|"
    assert one(spark, "ai_query('echo', 'a', responseFormat => 'f')") == "a|f"
    assert one(spark, "ai_query('echo', cast(null as string))") is None
    assert one(spark, "ai_gen('reply to: ' || 'x')") == "REPLY TO: X"
    with pytest.raises(Exception, match="unknown endpoint"):
        one(spark, "ai_query('nobody', 'a')")


def test_model_is_called_once_below_a_filter(spark, functions):
    spark.range(3).createOrReplaceTempView("three")
    df = spark.sql("SELECT * FROM (SELECT id, ai_query('echo', string(id)) AS r, length(r) AS n FROM three) WHERE n > 1")
    assert plan_of(df).count("ArrowEvalPython [") == 1
    assert df.count() == 3


def test_text_functions(spark, functions):
    assert one(spark, "ai_mask('mail a@b.org from Shop X', array('email', 'store'))") == "mail [MASKED] from [MASKED]"
    assert one(spark, "ai_extract('Shop X or Shop X', array('store', 'email'))") == {"store": ["Shop X"], "email": []}
    assert one(spark, "ai_similarity('a b', 'b c')") == pytest.approx(1 / 3)
    assert one(spark, "ai_classify('news from Asia and Europe, Asia first', array('Europe', 'Asia'))") == "Asia"
    assert one(spark, "ai_classify('nothing', array('Europe', 'Asia'))") is None
    assert one(spark, "ai_analyze_sentiment('good good bad')") == "positive"
    assert one(spark, "ai_analyze_sentiment('')") == "neutral"
    assert one(spark, "ai_translate('Hello, big world', 'es')") == "hola, big mundo"
    assert one(spark, "ai_translate('Hello', 'xx')") == "Hello"


def test_grammar_is_the_same_in_sql(spark, sf, functions):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.withColumn("a", baselines.fix_grammar(F.col("text"))).withColumn("b", F.expr("ai_fix_grammar(text)"))
    assert docs.filter("a <> b").isEmpty() and docs.filter("a <> text").count() > 0


def test_long_lists_and_unknown_labels(spark):
    model_sql.register_model_functions(spark, lexicon={f"w{n}": 1 for n in range(1000)})
    assert spark.sql("SELECT ai_analyze_sentiment('w999 x')").head()[0] == "positive"
    for call in ("ai_mask('a b', array('no_such'))", "ai_extract('a b', array('no_such'))"):
        with pytest.raises(Exception, match="no pattern for no_such"):
            spark.sql(f"SELECT {call} FROM range(1)").collect()


def test_summaries_in_sql(spark):
    model_sql.register_model_functions(spark)
    text = "Cats like fish. Dogs like cats and cats like dogs! Rain fell.\nNothing else."
    got = spark.sql(f"SELECT ai_summarize('{text}', 3) AS a, ai_summarize('{text}') AS b, ai_summarize(NULL) AS c, ai_summarize('') AS d, ai_summarize('?!', 5) AS e").head()
    assert got["a"] == "Dogs like cats and cats like dogs!"
    assert got["b"] == "Cats like fish. Dogs like cats and cats like dogs! Rain fell. Nothing else."
    assert (got["c"], got["d"], got["e"]) == (None, "", "")
