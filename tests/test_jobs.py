"""Feedback, conversations, evaluation, word rules, functions and lookups on small fixtures."""

import json
import os
import random
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corpusloom.functions import registry
from corpusloom.operators import baselines, conversations as conv, evaluation, feedback, relational as rel
from corpusloom.plans import skew


def assessments(spark):
    def at(hour):
        return datetime(2024, 1, 1, hour)

    rows = [
        (1, 1, "a", at(10), "t1", None),
        (1, 1, "b", at(11), "t2", None),
        (1, 1, "a", at(10), None, "r1"),
        (1, 2, "a", at(10), None, "r2"),
        (1, 1, "b", at(10), None, "r3"),
        (1, 2, "b", at(10), None, "r4"),
        (2, 1, "a", at(10), None, "r5"),
    ]
    df = spark.createDataFrame(
        rows, "request_id int, step_id int, reviewer string, timestamp timestamp, text_assessment string, retrieval_assessment string"
    )
    return df.select("*", F.struct(F.col("reviewer").alias("id")).alias("source"), F.lit("v1").alias("schema_version")).drop("reviewer")


def merged(df):
    return sorted(
        (
            (r["request_id"], r["source"] and r["source"]["id"], r["text_assessment"], r["retrieval_assessments"])
            for r in df.collect()
        ),
        key=str,
    )


def test_assessments_compat(spark):
    got = merged(feedback.deduplicate_assessments(assessments(spark), "compat"))
    assert got == sorted(
        [(1, "b", "t2", ["r3"]), (1, "b", "t2", ["r4"]), (None, None, None, ["r1"]), (None, None, None, ["r2"]), (None, None, None, ["r5"])],
        key=str,
    )


def test_assessments_fixed(spark):
    df = assessments(spark)
    want = [(1, "a", "t1", ["r1", "r2"]), (1, "b", "t2", ["r3", "r4"]), (2, "a", None, ["r5"])]
    assert merged(feedback.deduplicate_assessments(df)) == sorted(want, key=str)
    assert merged(feedback.deduplicate_assessments(df, list_limit=2)) == sorted(want, key=str)
    with pytest.raises(Exception, match="more than 1 retrieval assessments"):
        feedback.deduplicate_assessments(df, list_limit=1).collect()


PAYLOAD = {
    "name": "x",
    "height": 1,
    "weight": 2,
    "abilities": [{"ability": {"name": "p"}}],
    "types": [{"type": {"name": "q"}}],
    "stats": [{"stat": {"name": "hp"}, "base_stat": 9}],
}


def test_payload_lookup(spark):
    dim = spark.createDataFrame([("x", json.dumps(PAYLOAD))], "key string, body string")
    asked = spark.createDataFrame([("X",), ("nobody",)], "name_asked string")
    out = rel.lookup_enrich(asked, "name_asked", dim, "key", "body", rel.PAYLOAD_DDL)
    rows = {r[0]: r for r in out.select("name_asked", *rel.flatten_payload(F.col("payload"))).collect()}
    assert rows["X"][1:] == ("x", 1, 2, ["p"], ["q"], ["hp"], [9])
    assert set(rows["nobody"][1:]) == {None}


def test_tool_calls(spark):
    def call(id, name):
        return {"id": id, "function": {"name": name, "arguments": json.dumps({"item": "X"})}}

    rows = [
        (1, 0, "user", "hi", None),
        (1, 1, "assistant", "", json.dumps([call("c1", "lookup"), call("c2", "unknown")])),
        (2, 0, "user", "bye", None),
    ]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, tool_calls string")
    assert {r[0]: r[1] for r in conv.route(df).collect()} == {1: "continue", 2: "end"}
    tool = spark.createDataFrame([("x", 1, ["p"])], "key string, height int, abilities array<string>")
    answers = conv.dispatch_tools(df, {"lookup": tool}, "item").orderBy("turn").collect()
    assert [(r["conv_id"], r["turn"], r["role"], r["tool_call_id"], r["content"]) for r in answers] == [
        (1, 2, "tool", "c1", '{"height":1,"abilities":["p"]}'),
        (1, 3, "tool", "c2", None),
    ]
    assert {r[0]: r["answer"] for r in conv.final_answer(df).collect()} == {1: "", 2: "bye"}


def test_conversations_are_one_list_with_their_turns(spark):
    turns = F.when(F.col("id") < 5, F.col("id") * 10_000).otherwise(F.col("id") + 50_000)
    df = spark.range(25).select(F.lit(1).alias("conv_id"), turns.alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    listed = conv.assemble_messages(df.orderBy(F.rand(1)), "sys")
    (row,) = listed.collect()
    assert [m["content"] for m in row["messages"]] == ["sys"] + [str(n) for n in range(25)]
    flat = conv.flatten_updates(listed, ["conv_id"]).filter("role = 'user'").select("turn", "content").collect()
    assert sorted(map(tuple, flat)) == sorted((r["turn"], r["text"]) for r in df.collect())
    with pytest.raises(Exception, match="more than 24 messages"):
        conv.assemble_messages(df, most_messages=24).collect()


def test_tools_have_their_own_arguments_and_repeated_keys(spark):
    def call(id, name, **arguments):
        return {"id": id, "function": {"name": name, "arguments": json.dumps(arguments)}}

    calls = [call("1", "area", country="Peru"), call("2", "route", start="A", end="B"), call("3", "route", start="A")]
    df = spark.createDataFrame([(7, 3, json.dumps(calls))], "conv_id int, turn int, tool_calls string")
    area = spark.createDataFrame([("peru", 5), ("peru", 9)], "key string, km int")
    route = spark.createDataFrame([("a", "b", "r1")], "start string, end string, road string")
    names = {"area": "country", "route": ["start", "end"]}
    got = conv.dispatch_tools(df, {"area": area, "route": route}, names).collect()
    assert {r["tool_call_id"]: r["content"] for r in got} == {"1": '{"km":5}', "2": '{"road":"r1"}', "3": None}
    assert len(got) == 3


def test_votes_and_answers(spark):
    """Questions on ages 24, 12 and 31: right answers 58, 64, 54.5; wrong ones 42, 68, 58."""
    rows = [(24, "58"), (24, "42"), (24, "58"), (12, "64"), (12, "68"), (31, "54.5"), (31, "54.5"), (31, None)]
    votes = spark.createDataFrame(rows, "age int, answer string")
    assert {r["age"]: (r["answer"], r["votes"]) for r in rel.majority_vote(votes, "age", "answer").collect()} == {
        24: ("58", 2),
        12: ("64", 1),
        31: ("54.5", 2),
    }
    answers = spark.createDataFrame([("58", "58"), ("42", "58"), ("the answer is 64", "64")], "answer string, expected_response string")
    scores = [r["correctness"] for r in evaluation.evaluate(answers, ["correctness"]).collect()]
    assert scores == [1.0, 0.0, 0.4]


def test_measures_need_known_names(spark):
    with pytest.raises(ValueError):
        evaluation.evaluate(spark.range(1), ["beauty"])


def test_reading_ease(spark):
    df = spark.createDataFrame([("The cat sat on the mat.",), ("",)], "t string")
    got = [r[0] for r in df.select(evaluation.reading_ease(F.col("t"))).collect()]
    assert abs(got[0] - (206.835 - 1.015 * 6 - 84.6 * 6 / 6)) < 1e-9 and got[1] is None


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next_row(row, i, x, b)
    return row[-1]


def _next_row(above, i, x, b):
    row = [i]
    for j, y in enumerate(b, 1):
        row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row


@pytest.mark.parametrize("distance", [1, 2])
def test_nearest_term_is_exact(spark, distance):
    """Equal to comparing every word with every term, errors in the first letter included."""
    rng = random.Random(distance)
    words = ["".join(rng.choices("abc", k=rng.randrange(0, 6))) for _ in range(80)] + [None, "Abc"]
    terms = sorted({"".join(rng.choices("abcd", k=rng.randrange(1, 6))) for _ in range(25)})
    df = spark.createDataFrame([(n, w) for n, w in enumerate(words)], "id int, w string")
    dictionary = spark.createDataFrame([(t,) for t in terms], "term string")
    got = {r["id"]: (r["nearest"], r["distance"]) for r in rel.nearest_term(df, "w", dictionary, max_distance=distance).collect()}
    for n, w in enumerate(words):
        near = min(((edit_distance(w.lower(), t), t) for t in terms), default=None) if w is not None else None
        assert got[n] == ((near[1], near[0]) if near and near[0] <= distance else (None, None)), w


def test_grammar(spark):
    df = spark.createDataFrame([("this  is is a test , ok ?yes. the the end",)], "t string")
    assert df.select(baselines.fix_grammar(F.col("t"))).head()[0] == "This is a test, ok?Yes. The end"


def test_masks_and_entities(spark):
    df = spark.createDataFrame([("Dr. Lee lives at 12 Main Street, mail a.b@c.org or a.b@c.org, 10.0.0.1",)], "t string")
    masked = df.select(baselines.mask_entities(F.col("t"), ["person", "address", "email", "ip_address"])).head()[0]
    assert masked == "[MASKED] lives at [MASKED], mail [MASKED] or [MASKED], [MASKED]"
    found = baselines.extract(df, "t", {"mail": baselines.PATTERNS["email"], "city": baselines.terms_pattern(["Rome"])}).head()
    assert found["entities"].asDict() == {"mail": ["a.b@c.org"], "city": []}


def test_similarity(spark):
    df = spark.createDataFrame([("a a b", "a b b"), ("", "a"), ("x y", "x y"), ("p", "q")], "a string, b string")
    rows = [r[0] for r in df.select(baselines.similarity(F.col("a"), F.col("b"))).collect()]
    assert [round(r["jaccard"], 6) for r in rows] == [1, 0, 1, 0]
    assert [round(r["cosine"], 6) for r in rows] == [0.8, 0, 1, 0]


def test_summary_and_translation(spark):
    text = "Cats like fish. Dogs bark. Cats like cats and fish."
    df = spark.createDataFrame([(1, text), (2, ""), (3, "!!!")], "id int, t string")
    summary = baselines.summarize(F.col("t"), 1)
    assert [r[0] for r in df.select(summary).collect()] == ["Cats like fish.", "", ""]
    assert "Exchange" not in plan_of(df.select(summary))
    glossary = spark.createDataFrame([("cats", "gatos"), ("and", "y")], "source string, target string")
    got = {r["id"]: r["translation"] for r in baselines.translate(df, ["id"], "t", glossary).collect()}
    assert got == {1: "gatos like fish. Dogs bark. gatos like gatos y fish.", 2: "", 3: "!!!"}
    # A glossary of any length gives the same, also for repeated and null ids.
    many = glossary.union(spark.range(1000).selectExpr("concat('x', id)", "'y'"))
    again = spark.createDataFrame([(1, "Cats!"), (1, "and"), (None, "cats")], "id int, t string")
    for words in (glossary, many):
        rows = baselines.translate(again, ["id"], "t", words).collect()
        assert sorted((str(r["id"]), r["translation"]) for r in rows) == [("1", "gatos!"), ("1", "y"), ("None", "gatos")]


def test_sentiment_does_not_depend_on_the_lexicon_size(spark):
    rows = [(1, "good good bad"), (2, "bad"), (3, ""), (4, None), (5, "good"), (5, "good"), (None, "half half")]
    df = spark.createDataFrame(rows, "id int, t string")
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -1.0), ("half", 0.5)], "word string, weight double")
    many = lexicon.union(spark.range(1000).selectExpr("concat('x', id)", "1.0D"))
    want = {1: (1, "positive"), 2: (-1, "negative"), 3: (0, "neutral"), 4: (0, "neutral"), 5: (2, "positive"), None: (1, "positive")}
    for words in (lexicon, many):
        got = baselines.sentiment(df, ["id"], "t", words).collect()
        assert {r["id"]: (r["score"], r["sentiment"]) for r in got} == want


def test_classification_with_an_unseen_class(spark):
    df = spark.createDataFrame([("0", "0"), ("0", "2"), ("1", "0"), (None, "1")], "truth string, pred string")
    report = {r["class"]: r for r in rel.classification_report(df, "truth", "pred").collect()}
    assert (report["0"]["support"], report["0"]["precision"], report["0"]["recall"]) == (2, 0.5, 0.5)
    assert (report["1"]["support"], report["1"]["precision"], report["1"]["recall"]) == (1, None, 0.0)
    assert (report["2"]["support"], report["2"]["precision"], report["2"]["recall"]) == (0, 0.0, None)
    assert abs(report["0"]["accuracy"] - 1 / 3) < 1e-9
    matrix = rel.confusion_matrix(df.filter("truth is not null"), "truth", "pred", ["0", "1", "2"]).orderBy("truth").collect()
    assert [tuple(r) for r in matrix] == [("0", 1, 0, 1, 0), ("1", 1, 0, 0, 0)]


def test_malformed_and_missing_predictions_count(spark):
    df = spark.createDataFrame([("0", "0"), ("0", "not sure"), ("0", None), ("1", None)], "truth string, pred string")
    matrix = rel.confusion_matrix(df, "truth", "pred", ["0", "1"]).orderBy("truth").collect()
    assert [tuple(r) for r in matrix] == [("0", 1, 0, 2), ("1", 0, 0, 1)]
    report = {r["class"]: r for r in rel.classification_report(df, "truth", "pred").collect()}
    assert (report["0"]["support"], report["0"]["recall"]) == (3, 1 / 3) and report["1"]["support"] == 1
    assert report["0"]["accuracy"] == 0.25


def test_versions(spark):
    df = spark.createDataFrame([("m", "2"), ("m", "10"), ("n", "x")], "name string, version string")
    assert {r[0]: r[1] for r in rel.latest_version(df, "name", "version").collect()} == {"m": 10, "n": None}
    assert {r[0]: r[1] for r in rel.latest_version(df, "name", "version", 1).collect()} == {"m": 10, "n": 1}


def test_workers_need_no_copy_of_the_package(tmp_path):
    """A job with Python workers, started elsewhere and importing the package from its source folder."""
    root = Path(__file__).resolve().parents[1]
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {str(root)!r})\n"
        "from corpusloom.session import build_session\n"
        "from corpusloom.operators.embedding import embed\n"
        "spark = build_session('local[2]')\n"
        "print('rows', len(embed(spark.createDataFrame([('a b',)], 't string'), 't', dim=8).collect()))\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "rows 1" in done.stdout, done.stderr[-2000:]


FUNCTIONS = [
    registry.SqlFunction("double_it", "x INT", "INT", "Twice the number, it's exact.", "x * 2", "maths"),
    registry.SqlFunction("small_table", "", "TABLE(name STRING, n INT)", "Two rows.", "SELECT * FROM VALUES ('a', 1), ('b', 2)", "tables"),
]


def test_function_catalogue(spark):
    catalogue = registry.registry(spark, FUNCTIONS)
    listed = registry.list_functions(catalogue, "maths").collect()
    assert [(r["name"], r["comment"]) for r in listed] == [("double_it", "Twice the number, it's exact.")]
    assert registry.register_functions(spark, catalogue) == ["double_it", "small_table"]
    assert spark.sql("SELECT double_it(x => 4)").head()[0] == 8
    assert spark.sql("SELECT * FROM small_table()").dtypes == [("name", "string"), ("n", "int")]
    described = "\n".join(r[0] for r in registry.describe_function(spark, "double_it").collect())
    assert "Twice the number" in described
    with pytest.raises(ValueError):
        registry.register_functions(spark, [registry.SqlFunction("a b", "", "INT", "", "1")])


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_nearest_terms_match_all_pairs(spark, distance):
    import random

    rng = random.Random(distance)

    def word(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    terms = {word("ab", n) for n in range(1, 20) for _ in range(3)} | {word("中文字", n) for n in (1, 2) for _ in range(4)}
    terms |= {word("abcdef", n) for n in (15, 16, 17, 18, 20, 60)}
    found = []
    for t in sorted(terms):
        w = list(t)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(2)] = rng.choice([[], ["a"], ["x"]])
        found.append("".join(w))
    df = spark.createDataFrame([(w,) for w in found], "w string")
    table = spark.createDataFrame([(t,) for t in terms], "term string")
    got = {(r["w"], r["nearest"], r["distance"]) for r in rel.nearest_term(df, "w", table, max_distance=distance).collect()}
    pairs = df.distinct().crossJoin(table).withColumn("d", F.levenshtein("w", "term")).filter(F.col("d") <= distance)
    best = pairs.groupBy("w").agg(F.min(F.struct("d", "term")).alias("b")).collect()
    want = {(r["w"], r["b"]["term"], r["b"]["d"]) for r in best}
    assert {g for g in got if g[1] is not None} == want
    assert {g[0] for g in got} == set(found)


def test_correction_of_long_values_has_few_keys(spark):
    long = "q" * 2000
    df = spark.createDataFrame([(long + "x",)], "w string")
    terms = spark.createDataFrame([(long,)], "term string")
    assert rel.nearest_term(df, "w", terms).head()["distance"] == 1


def test_gazetteer_of_any_size(spark):
    df = spark.createDataFrame([(1, "Then Ana Lima met Bo, not Ann.")], "id int, t string")
    names = spark.createDataFrame([("ana lima",), ("BO",)], "term string")
    many = names.union(spark.range(500).selectExpr("concat('n', id)"))
    for table in (names, many):
        got = baselines.mask_terms(df, ["id"], "t", table).head()["translation"]
        assert got == "Then [MASKED] met [MASKED], not Ann."


def test_tries_and_word_blocks_of_any_number(spark):
    """Several tries for one length and several blocks of words give what one of each gives."""
    from corpusloom.operators.term_trie import nearest_terms

    rng = random.Random(6)
    terms = sorted({"".join(rng.choices("abcde", k=rng.randrange(1, 7))) for _ in range(120)})
    words = sorted({"".join(rng.choices("abcde", k=rng.randrange(0, 8))) for _ in range(150)} | {"é" * 300, "中文", "\U0001f600"})
    term_rows = spark.createDataFrame([(t, t.upper()) for t in [*terms, "é" * 299 + "x", "中", "\U0001f601"]], "term string, nearest string")
    word_rows = spark.createDataFrame([(w,) for w in words], "word string")
    want = {}
    for w in words:
        best = min((edit_distance(w, r["term"]), r["nearest"]) for r in term_rows.collect() if abs(len(w) - len(r["term"])) <= 2)
        if best[0] <= 2:
            want[w] = best
    for trie_terms, block_words in ((65_536, 16_384), (7, 5)):
        rows = nearest_terms(word_rows, term_rows, 2, trie_terms, block_words).collect()
        assert {r["word"]: (r["distance"], r["nearest"]) for r in rows} == want
    assert nearest_terms(word_rows, term_rows.limit(0), 2).collect() == [] == nearest_terms(word_rows.limit(0), term_rows, 2).collect()


def test_phrases_are_replaced_leftmost_and_longest(spark):
    phrases = [("New York", "NY"), ("new york city", "NYC"), ("York", "Y"), ("city of", "c"), ("Saint-Denis", "SD"), ("", "x"), (None, "y"), ("!", "z")]
    table = spark.createDataFrame(phrases, "source string, target string")
    texts = {
        1: ("In New  York City of lights, new york; York.", "In NYC of lights, NY; Y."),
        2: ("new, York newyork New\nYork's", "new, Y newyork NY's"),
        3: ("Saint-Denis saint denis", "SD saint denis"),
        4: ("", ""),
        5: (None, None),
        6: ("nothing here", "nothing here"),
        None: ("York " * 3000, "Y " * 3000),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in texts.items()], "id int, t string").repartition(3)
    got = {r["id"]: r["translation"] for r in baselines.replace_phrases(df, ["id"], "t", table).collect()}
    assert got == {k: v[1] for k, v in texts.items()}
    unchanged = {r["id"]: r["translation"] for r in baselines.replace_phrases(df, ["id"], "t", table.limit(0)).collect()}
    assert unchanged == {k: v[0] for k, v in texts.items()}
