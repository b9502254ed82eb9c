"""The log-structured index against a dictionary, and what it writes."""

import random

import pytest

from corpusloom.operators import index_sync
from corpusloom.plans.workspace import fresh_path


def frame(spark, content):
    rows = [(k, v) for k, v in content.items()]
    return spark.createDataFrame(rows, "id bigint, text string").repartition(2)


def with_hash(rows):
    return rows.withColumn(index_sync.HASH_COLUMN, index_sync.content_hash(["text"]))


def sync(spark, root, content):
    counts = index_sync.sync_index(frame(spark, content), root, "id", ["text"], with_hash).collect()
    return {r["_change_type"]: r["count"] for r in counts}


def read(spark, root):
    return {r["id"]: r["text"] for r in index_sync.current_version(spark, root, "id").collect()}


def changes(old, new):
    out = {
        "insert": len(new.keys() - old.keys()),
        "delete": len(old.keys() - new.keys()),
        "update": sum(old[k] != new[k] for k in old.keys() & new.keys()),
    }
    return {k: n for k, n in out.items() if n}


def test_many_syncs_give_what_a_dictionary_holds(spark):
    rng, root = random.Random(3), fresh_path(spark, "log")
    content = {k: f"text {k}" for k in range(60)}
    assert sync(spark, root, content) == {"insert": 60}
    for step in range(6):
        before = dict(content)
        for k in rng.sample(range(90), 12):
            if k in content and rng.random() < 0.4:
                del content[k]
            else:
                content[k] = rng.choice([None, "", f"step {step}", f"text {k}"])
        assert sync(spark, root, content) == changes(before, content)
        assert read(spark, root) == content
    assert sync(spark, root, content) == {}
    parts = index_sync.current_parts(spark, root)
    assert parts[0].is_base and len(parts) <= 4
    index_sync.drop_superseded(spark, root)
    assert read(spark, root) == content and index_sync.current_parts(spark, root) == parts


def test_a_sync_writes_in_proportion_to_the_change(spark):
    rng, root = random.Random(4), fresh_path(spark, "log")
    content = {k: "".join(rng.choices("abcdefghijklmnop ", k=300)) for k in range(4000)}
    sync(spark, root, content)
    (base,) = index_sync.current_parts(spark, root)
    content[7], content[4001] = "new", "more"
    del content[8]
    assert sync(spark, root, content) == {"update": 1, "insert": 1, "delete": 1}
    first, delta = index_sync.current_parts(spark, root)
    assert first == base and delta.size < 0.01 * base.size
    assert read(spark, root) == content


def test_deltas_of_like_size_are_merged_and_large_ones_become_a_base(spark):
    root, content = fresh_path(spark, "log"), {k: f"{k} " * 200 for k in range(300)}
    sync(spark, root, content)
    for step in range(3):
        content[step] = f"changed {step}"
        sync(spark, root, content)
    base, *deltas = index_sync.current_parts(spark, root)
    assert len(deltas) == 1 and deltas[0].first == 2 and deltas[0].last == 4
    content = {k: f"{v} again" for k, v in content.items()}
    sync(spark, root, content)
    (merged,) = index_sync.current_parts(spark, root)
    assert merged.is_base and merged.last == 5 and read(spark, root) == content


@pytest.mark.parametrize("after", [0, 1, 2])
def test_what_a_failed_sync_leaves_is_not_read(spark, after):
    root, content = fresh_path(spark, "log"), {1: "a", 2: "b"}
    for step in range(after):
        content[step] = f"step {step}"
        sync(spark, root, content)
    # Files of a part that never became complete.
    number = index_sync._parts(spark, root)[1] + 1
    broken = f"{root}/part={number:08d}-{number:08d}-broken00"
    frame(spark, {5: "never", 6: "read"}).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(broken)
    content[3] = "later"
    sync(spark, root, content)
    assert read(spark, root) == content
