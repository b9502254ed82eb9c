"""Model requests written in SQL: every distinct one asked once, replies in the requests' places."""

import pytest
from conftest import plan_of

from corpusloom.operators import requests


@pytest.fixture(scope="module")
def asks(spark):
    return requests.register_requests(spark)


def logged_backend(folder):
    """Echoes prompts and writes each one asked into a file of its own."""

    def backend(texts, form):
        from pathlib import Path
        from uuid import uuid4

        for text in texts:
            Path(folder, uuid4().hex).write_text(f"{text}|{form}")
        return [f"{text}!{form or ''}" for text in texts]

    return backend


def asked(folder):
    return sorted(p.read_text() for p in folder.iterdir())


def test_each_distinct_request_is_asked_once_over_many_batches(spark, asks, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        # Half of all rows share one prompt, over 16 partitions.
        spark.range(0, 400, 1, 16).selectExpr("id", "CAST(if(id % 2 = 0, 0, id % 9) AS STRING) AS p").createOrReplaceTempView("asking")
        df = spark.sql("SELECT id, p, ai_request('echo', p) AS a, ai_request('echo', p) AS b, ai_request('echo', p, responseFormat => 'f') AS c FROM asking")
        out = requests.answer_requests(df, {"echo": logged_backend(str(tmp_path))}, batch_size=2)
        rows = out.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out.columns == ["id", "p", "a", "b", "c"] and len(rows) == 400
    assert all(r["a"] == r["b"] == f"{r['p']}!" and r["c"] == f"{r['p']}!f" for r in rows)
    expected = sorted(f"{p}|{form}" for p in {str(0 if i % 2 == 0 else i % 9) for i in range(400)} for form in ("None", "f"))
    assert asked(tmp_path) == expected
    # Neither a second action nor a filter on the reply asks again.
    assert out.filter("a = '0!'").count() == sum(r["p"] == "0" for r in rows)
    assert asked(tmp_path) == expected


def test_requests_that_look_alike_stay_apart(spark, asks):
    backends = {"a": lambda ts, f: [f"a:{t}:{f}" for t in ts], "ab": lambda ts, f: [f"ab:{t}:{f}" for t in ts]}
    df = spark.sql("""
        SELECT n, ai_request(e, t, responseFormat => f) AS r FROM VALUES
          (0, 'a', 'bc', CAST(NULL AS STRING)), (1, 'ab', 'c', NULL), (2, 'a', 'bc', ''), (3, 'a', 'b', 'c'),
          (4, 'a', '', NULL), (5, 'a', NULL, NULL), (6, 'a', 'x"y\\n', NULL) AS v(n, e, t, f)""")
    got = [r["r"] for r in requests.answer_requests(df, backends).orderBy("n").collect()]
    assert got == ["a:bc:None", "ab:c:None", "a:bc:", "a:b:c", "a::None", None, 'a:x"y\n:None']


def test_defined_results(spark, asks):
    echo = {"echo": lambda texts, form: list(texts)}
    plain = spark.range(2)
    assert requests.answer_requests(plain, echo) is plain
    none = spark.sql("SELECT id, ai_request('echo', 'x') AS `a.b` FROM range(0)")
    assert requests.answer_requests(none, echo).collect() == []
    dotted = spark.sql("SELECT id AS `i.d`, ai_request('echo', 'long ' || repeat('x', 100000)) AS `a.b` FROM range(2)")
    out = requests.answer_requests(dotted, echo)
    assert out.columns == ["i.d", "a.b"] and {len(r[1]) for r in out.collect()} == {100005}
    for endpoint in ("'nobody'", "CAST(NULL AS STRING)"):
        with pytest.raises(Exception, match="unknown endpoint"):
            requests.answer_requests(spark.sql(f"SELECT ai_request({endpoint}, 'x') AS r"), echo)
    twice = spark.sql("SELECT ai_request('echo', 'x') AS r, 1 AS n, 2 AS n")
    with pytest.raises(ValueError, match="distinct"):
        requests.answer_requests(twice, echo)


def test_no_exchange_of_the_result_carries_prompts(spark, asks, sf):
    spark.read.parquet(f"{sf}/documents.parquet").createOrReplaceTempView("request_docs")
    df = spark.sql("SELECT doc_id, ai_request('echo', text) AS r FROM request_docs")
    plan = plan_of(requests.answer_requests(df, {"echo": lambda texts, form: [str(len(t)) for t in texts]}))
    assert "Python" not in plan
    exchanges = [i for i, line in enumerate(plan.split("\n")) if "Exchange" in line]
    below = plan.split("\n")
    assert exchanges and all("text#" not in below[i] and "model_request" not in below[i] for i in exchanges)
    # What is exchanged is the projection right below: the id and the hash of the request.
    assert any("Project [doc_id#" in line and "__key_0" in line for line in below)


def test_distinct_requests_sort_nothing(spark, asks):
    rows = spark.range(100).selectExpr("id", "ai_request('m', concat('p', id % 3)) AS a", "ai_request('m', if(id % 2 = 0, 'p1', NULL)) AS b")
    found = requests.distinct_requests(rows, [rows["a"], rows["b"]])
    assert found.count() == 3
    assert "Sort" not in plan_of(found)
