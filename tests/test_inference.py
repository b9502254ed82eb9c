import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corpusloom.operators import inference, prompts, structured
from corpusloom.plans.workspace import fresh_path

DDL = "sentiment STRING"
ENUMS = {"sentiment": ["0", "1", "2"]}

REPLIES = [
    ('{"sentiment":"1"}', "1", True, 1),
    ('{"sentiment":"7"}', "7", False, 7),
    ("bullish", None, False, None),
    ('{"sentiment":"x1"}', "x1", False, None),
    ("{}", None, False, None),
    (None, None, False, None),
    ('["1"]', None, False, None),
]


@pytest.mark.parametrize("reply,value,valid,number", REPLIES)
def test_reply_checks(spark, reply, value, valid, number):
    df = spark.createDataFrame([(reply,)], "reply string")
    row = structured.parse_reply(df, "reply", DDL, ENUMS, ["sentiment"]).withColumn(
        "n", structured.json_number(F.col("reply"), "$.sentiment")
    ).head()
    assert (row["parsed"]["sentiment"] if row["parsed"] else None) == value
    assert row["valid"] is valid and bool(row["reasons"]) is not valid
    assert row["n"] == number


def test_jsonl(spark):
    reply = """```jsonl
{"city": "Lima", "river": "Rimac", "bridges": 11},

5
{"city": "Graz", "river": "Mur", "bridges": 14},
{"city": "Turku", "river":
true
```"""
    df = spark.createDataFrame([(1, reply)], "id int, reply string")
    rows = structured.parse_jsonl(df, "reply", "city STRING, river STRING, bridges INT", ["id"]).collect()
    assert [r["parsed"]["bridges"] for r in rows if r["valid"]] == [11, 14]
    assert [(r["line"], r["parsed"]) for r in rows if not r["valid"]] == [("5", None), ('{"city": "Turku", "river":', None), ("true", None)]


def test_multi_values(spark):
    df = spark.createDataFrame([("AAPL, MSFT,,AAPL ,",), ("",)], "t string")
    assert [r[0] for r in df.select(structured.split_multi(F.col("t"))).collect()] == [["AAPL", "MSFT"], []]


def asked_file(tmp_path):
    """Backend that writes down each prompt it is asked."""
    log = tmp_path / "asked"

    def backend(texts):
        assert len(texts) <= 2
        with open(log, "a") as f:
            f.writelines(t + "\n" for t in texts)
        return [t.upper() for t in texts]

    return backend, lambda: sorted(log.read_text().split())


def test_each_prompt_is_asked_once(spark, tmp_path):
    backend, asked = asked_file(tmp_path)
    rows = [(n, p) for n, p in enumerate(["a", "b", "a", "a", None, "c", "a"])]
    df = spark.createDataFrame(rows, "id int, p string").repartition(3)
    out = inference.infer(df, "p", backend, batch_size=2)
    assert plan_of(out.filter("reply = 'A'")).count("MapInPandas") == 1
    got = {r["id"]: r["reply"] for r in out.collect()}
    assert got == {n: p and p.upper() for n, p in rows}
    assert asked() == ["a", "b", "c"]


def test_stored_replies_are_not_asked_again(spark, tmp_path):
    backend, asked = asked_file(tmp_path)
    store = fresh_path(spark, "replies")
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "p string")
    first = inference.infer(df, "p", backend, batch_size=2, store=store, model="m1")
    assert first.count() == 3 and first.filter("reply = 'A'").count() == 2
    more = spark.createDataFrame([("a",), ("c",)], "p string")
    assert {r["reply"] for r in inference.infer(more, "p", backend, batch_size=2, store=store, model="m1").collect()} == {"A", "C"}
    assert asked() == ["a", "b", "c"]
    with pytest.raises(ValueError, match="name of the model"):
        inference.infer(df, "p", backend, store=store)


def test_models_do_not_share_replies_of_a_store(spark):
    store = fresh_path(spark, "replies")
    df = spark.createDataFrame([("a", "x")], "p string, t string")
    models = {"one": lambda texts: ["1"] * len(texts), "two": lambda texts: ["2"] * len(texts)}
    for _ in range(2):
        got = inference.compare_models(df, "p", models, "t", store=store).collect()
        assert {r["model"]: r["pred"] for r in got} == {"one": "1", "two": "2"}


def test_failed_calls(spark):
    def broken(texts):
        raise RuntimeError("model is down")

    df = spark.createDataFrame([("a",)], "p string")
    with pytest.raises(Exception, match="model is down"):
        inference.infer(df, "p", broken).collect()
    assert inference.infer(df, "p", broken, on_error="null").head()["reply"] is None
    store = fresh_path(spark, "replies")
    assert inference.infer(df, "p", broken, on_error="null", store=store, model="m").head()["reply"] is None
    assert inference.infer(df, "p", lambda t: ["late"], store=store, model="m").head()["reply"] == "late"


def test_retrying():
    tries = []

    def flaky(texts):
        tries.append(1)
        if len(tries) < 3:
            raise RuntimeError("busy")
        return texts

    assert inference.retrying(flaky, wait=0)(["x"]) == ["x"] and len(tries) == 3

    def broken(texts):
        raise RuntimeError("down")

    with pytest.raises(RuntimeError):
        inference.retrying(broken, wait=0)(["x"])


def test_rejected_rows_are_asked_once_more(spark):
    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "worse")], "id int, p string")

    def first(texts):
        return ['{"sentiment":"1"}' if t == "good" else "?" for t in texts]

    def second(texts):
        return ['{"sentiment":"2"}' if t == "bad" else "?" for t in texts]

    answered = inference.infer(df, "p", first, "reply", DDL, ENUMS, ["sentiment"])
    rows = inference.retry_rejected(answered, "p", second, "reply", DDL, ENUMS, ["sentiment"]).collect()
    assert {r["id"]: r["valid"] for r in rows} == {1: True, 2: True, 3: False}


def test_prompts(spark):
    df = spark.createDataFrame([("x", 1), (None, 2)], "a string, b int")
    assert [r[0] for r in df.select(prompts.render_prompt("<{a}|{b}>", "a", "b")).collect()] == ["<x|1>", None]
    assert df.select(prompts.instruct("Say ", F.col("a"))).head()[0] == "Say x"
    with pytest.raises(ValueError):
        prompts.render_prompt("{c}", "a")


def test_too_many_examples_fail(spark):
    few = spark.range(3).select(F.col("id").alias("pos"), F.concat(F.lit("e"), "id").alias("example"))
    shots = spark.range(1).select(prompts.few_shot_prompt("do", few, "think"))
    assert shots.head()[0] == "do\ne0\ne1\ne2\nthink"
    many = spark.range(1001).select(F.col("id").alias("pos"), F.lit("e").alias("example"))
    assert spark.range(1).select(prompts.few_shot_prompt("do", many, "think")).head()[0].count("\n") == 1002
    with pytest.raises(Exception, match="too many examples"):
        spark.range(1).select(prompts.few_shot_prompt("do", many, "think", most_examples=1000)).collect()


def test_retry_asks_the_first_model_once(spark, tmp_path):
    backend, asked = asked_file(tmp_path)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    answered = inference.infer(df, "p", backend, "reply", DDL, ENUMS, ["sentiment"], batch_size=2)
    again = inference.retry_rejected(answered, "p", lambda t: ['{"sentiment":"1"}'] * len(t), "reply", DDL, ENUMS, ["sentiment"])
    assert again.filter("valid").count() == 2 and again.count() == 2
    assert asked() == ["a", "b"]
