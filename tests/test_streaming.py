import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import chunking, embedding
from corpusloom.plans.corpus import chunk_table, index_table
from corpusloom.plans.workspace import fresh_path
from corpusloom.sources import files
from corpusloom.sources.tables import with_chunk_id
from corpusloom.streaming import incremental, shared_table

SCHEMA = "doc_id long, text string, lang string"


def chunk(df):
    return with_chunk_id(chunking.chunk_documents(df, "text", ["doc_id"]), "doc_id")


def embed(df):
    return embedding.embed(df, "content", dim=8)


def arrived(df, folder):
    df.write.mode("append").parquet(folder)


def run(spark, folder, target, checkpoint):
    stream = files.stream_parquet(spark, folder, SCHEMA)
    return incremental.run_incremental_corpus(stream, target, checkpoint, chunk, embed, is_path=True)


def test_incremental_equals_batch(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    folder, target, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "ckpt"))
    arrived(docs.filter("lang = 'en'"), folder)
    assert run(spark, folder, target, checkpoint)["input_rows"] > 0
    arrived(docs.filter("lang <> 'en'"), folder)
    run(spark, folder, target, checkpoint)
    assert run(spark, folder, target, checkpoint)["input_rows"] == 0
    written = spark.read.parquet(target)
    batch = embed(chunk(docs))
    assert Counter(r["id"] for r in written.collect()) == Counter(r["id"] for r in batch.collect())
    assert written.exceptAll(batch.select(*written.columns)).isEmpty()


def test_table_source_and_sink(spark):
    source, sink = f"raw_{uuid.uuid4().hex}", f"chunks_{uuid.uuid4().hex}"
    checkpoint = fresh_path(spark, "ckpt")
    text = " ".join(f"w{n}" for n in range(700))
    spark.createDataFrame([(1, text, "en")], SCHEMA).write.saveAsTable(source)

    def load():
        incremental.run_incremental(chunk(incremental.table_stream(spark, source)), sink, checkpoint)
        return spark.table(sink).count()

    first = load()
    assert first == 2 and load() == 2
    spark.createDataFrame([(2, text, "en")], SCHEMA).write.mode("append").saveAsTable(source)
    assert load() == 4


def test_two_sources_share_a_table(spark):
    docs = spark.createDataFrame([(n, " ".join("abc" * 10), "en") for n in range(4)], SCHEMA)
    root = fresh_path(spark, "shared")
    for name, rule in (("even", "doc_id % 2 = 0"), ("odd", "doc_id % 2 = 1")):
        folder = fresh_path(spark, "in")
        arrived(docs.filter(rule), folder)
        run(spark, folder, incremental.source_path(root, name), fresh_path(spark, "ckpt"))
    assert sorted(r["doc_id"] for r in incremental.read_sources(spark, root).collect()) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        incremental.source_path(root, "../x")


def test_second_checkpoint_on_one_sink_is_refused(spark):
    docs = spark.createDataFrame([(1, " ".join("abc" * 10), "en")], SCHEMA)
    folder, target = fresh_path(spark, "in"), fresh_path(spark, "out")
    arrived(docs, folder)
    run(spark, folder, target, fresh_path(spark, "ckpt"))
    with pytest.raises(ValueError, match="another checkpoint"):
        run(spark, folder, target, fresh_path(spark, "ckpt"))


def test_binary_files_stream(spark, tmp_path):
    (tmp_path / "a.txt").write_text(" ".join(f"w{n}" for n in range(30)))
    (tmp_path / "skip.bin").write_bytes(b"x")
    target, checkpoint = fresh_path(spark, "out"), fresh_path(spark, "ckpt")

    def load():
        stream = files.decode_text(files.stream_files(spark, str(tmp_path), "*.txt"))
        chunks = chunking.chunk_sentences(stream, "text", ["path"]).selectExpr("path AS url", "content")
        incremental.run_incremental(chunks, target, checkpoint, is_path=True)
        return spark.read.parquet(target).count()

    assert load() == 1
    (tmp_path / "b.txt").write_text("Another file. With two sentences.")
    assert load() == 2 and load() == 2


def test_page_to_index(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    chunks = chunk_table(pages)
    index = index_table(chunks, dim=16)
    assert index.columns == ["id", "embedding", "url", "content"]
    assert index.count() == chunks.count() > 0
    assert index.filter(F.size("embedding") != 16).isEmpty()


def test_all_batches_are_counted(spark, tmp_path):
    """More batches than a query keeps progress of."""
    spark.range(12).repartition(12).write.parquet(str(tmp_path / "in"))
    files_written = len(list((tmp_path / "in").glob("part-*")))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        stream = files.stream_parquet(spark, str(tmp_path / "in"), "id bigint", max_files=1)
        got = incremental.run_incremental(stream, str(tmp_path / "out"), str(tmp_path / "check"), is_path=True)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert got == {"batches": files_written, "input_rows": 12}


def test_streams_read_folders_and_files(spark, tmp_path):
    spark.range(9).repartition(3).write.parquet(str(tmp_path / "t.parquet"))
    one = next((tmp_path / "t.parquet").glob("part-*"))
    for n, (path, rows) in enumerate(((tmp_path / "t.parquet", 9), (one, spark.read.parquet(str(one)).count()))):
        stream = files.stream_parquet(spark, str(path), "id bigint", max_bytes=1 << 20)
        got = incremental.run_incremental(stream, str(tmp_path / f"out{n}"), str(tmp_path / f"check{n}"), is_path=True)
        assert got["input_rows"] == rows


def test_streams_feed_one_table_once(spark, tmp_path):
    root = str(tmp_path / "table")
    docs = spark.createDataFrame([(n, " ".join("abc" * 10), "en") for n in range(6)], SCHEMA)
    checks = {}

    def run_feed(name, rule):
        folder = fresh_path(spark, "in")
        arrived(docs.filter(rule), folder)
        checks[name] = (folder, fresh_path(spark, "ckpt"))
        return feed(name)

    def feed(name, checkpoint=None):
        folder, own = checks[name]
        stream = files.stream_parquet(spark, folder, SCHEMA)
        return shared_table.feed_table(stream, root, checkpoint or own, {name: lambda b: b.select("doc_id", "text")})

    def ids():
        return sorted(r["doc_id"] for r in shared_table.read_table(spark, root).collect())

    assert run_feed("even", "doc_id % 2 = 0")["input_rows"] == 3
    assert ids() == [0, 2, 4]
    assert run_feed("odd", "doc_id % 2 = 1")["input_rows"] == 3
    assert ids() == [0, 1, 2, 3, 4, 5]
    # Nothing new; then the first batch again, as after a loss of the checkpoint: it is not even read.
    assert feed("even")["input_rows"] == 0 and feed("even", fresh_path(spark, "ckpt")) == {"batches": 1, "input_rows": 0}
    assert ids() == [0, 1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        shared_table.append_batch(docs, root, "../x", 0)


def test_batches_without_commit_are_not_read(spark, tmp_path):
    root = str(tmp_path / "table")
    docs = spark.createDataFrame([(1, "a", "en")], SCHEMA)
    docs.write.parquet(f"{root}/data/feed-0-broken")
    with pytest.raises(ValueError, match="nothing committed"):
        shared_table.read_table(spark, root)
    assert shared_table.append_batch(docs, root, "feed", 0) and not shared_table.append_batch(docs, root, "feed", 0)
    assert shared_table.read_table(spark, root).count() == 1


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path):
    lines = [f"{n} " + "x" * (n % 97) for n in range(5000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.txt").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        stream = files.stream_lines(spark, str(tmp_path / "in"), "*.txt")
        told = stream.withColumn("task", F.spark_partition_id())
        incremental.run_incremental(told, str(tmp_path / "out"), str(tmp_path / "check"), is_path=True)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert Counter(r["line"] for r in rows) == Counter(lines)
    tasks = Counter(r["task"] for r in rows)
    assert len(tasks) > 5 and max(tasks.values()) < len(lines) / 2
