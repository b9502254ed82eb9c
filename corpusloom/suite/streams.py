"""Incremental jobs, run to completion and read back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from corpusloom.operators import chunking, embedding
from corpusloom.plans.workspace import fresh_path
from corpusloom.sources import files
from corpusloom.sources.tables import with_chunk_id
from corpusloom.streaming import incremental, shared_table
from corpusloom.suite import Suite, table
from corpusloom.suite.corpus import EMBED_DIM, windows_sql

suite = Suite()


@suite.add(
    f"""SELECT md5(concat_ws('|', doc_id, pos, content)) AS id, doc_id, {EMBED_DIM} AS dimensions
FROM ({windows_sql('SELECT doc_id, text FROM documents', 'doc_id')})"""
)
def streamed_index(spark, sf):
    """Documents streamed through chunking and embedding into a table; the second run adds nothing."""
    schema = table(spark, sf, "documents").schema
    target, checkpoint = fresh_path(spark, "streamed"), fresh_path(spark, "checkpoint")

    def chunk(df):
        return with_chunk_id(chunking.chunk_windows(df, "text", ["doc_id"]), "doc_id")

    def embed(df):
        return embedding.embed(df, "content", dim=EMBED_DIM).select("id", "doc_id", "content", "embedding")

    for _ in range(2):
        stream = files.stream_parquet(spark, f"{sf}/documents.parquet", schema, max_bytes=1 << 30)
        # The one file is one split: its rows are dealt over the cores before they are cut and embedded.
        incremental.run_incremental_corpus(stream, target, checkpoint, chunk, embed, True, spark.sparkContext.defaultParallelism)
    written = spark.read.parquet(target)
    return written.select("id", "doc_id", F.size("embedding").alias("dimensions"))


@suite.add(
    f"SELECT doc_id, pos, n_tokens, md5(content) AS digest FROM ({windows_sql('SELECT doc_id, text FROM documents', 'doc_id')})"
)
def two_sources(spark, sf):
    """English and other documents as two feeds of one table, read once; the second run and a replayed batch add nothing."""
    schema = table(spark, sf, "documents").schema
    target, checkpoint = fresh_path(spark, "appended"), fresh_path(spark, "checkpoint")

    def chunks_of(rule):
        return lambda batch: chunking.chunk_windows(batch.filter(rule), "text", ["doc_id"])

    feeds = {"english": chunks_of("lang <=> 'en'"), "other": chunks_of("NOT lang <=> 'en'")}
    for start in (checkpoint, checkpoint, fresh_path(spark, "replayed")):
        stream = files.stream_parquet(spark, f"{sf}/documents.parquet", schema, max_bytes=1 << 30)
        shared_table.feed_table(stream, target, start, feeds)
    written = shared_table.read_table(spark, target)
    return written.select("doc_id", "pos", "n_tokens", F.md5("content").alias("digest"))


@suite.add("SELECT doc_id, md5(coalesce(text, '')) AS digest FROM documents")
def streamed_files(spark, sf):
    """The documents as lines of text files, which are streamed by ranges of bytes and decoded."""
    folder, target, checkpoint = (fresh_path(spark, x) for x in ("lines", "files", "checkpoint"))
    # Hexadecimal keeps line breaks within a text out of the lines.
    line = F.concat_ws(" ", "doc_id", F.hex(F.coalesce("text", F.lit("")).cast("binary")))
    table(spark, sf, "documents").select(line).write.text(folder)
    rows = files.stream_lines(spark, folder, "part-*", max_bytes=1 << 30).filter("line <> ''").select(F.split("line", " ").alias("parts"))
    found = rows.select(
        F.get("parts", F.lit(0)).cast("long").alias("doc_id"),
        F.md5(F.unhex(F.coalesce(F.get("parts", F.lit(1)), F.lit("")))).alias("digest"),
    )
    incremental.run_incremental(found, target, checkpoint, is_path=True)
    return spark.read.parquet(target)


@suite.add("SELECT user_id, event_type, count(*) AS events FROM events GROUP BY ALL")
def streamed_table(spark, sf):
    """Events copied into a managed table and read from it as a stream with bounded batches."""
    name = f"events_{uuid4().hex}"
    events = table(spark, sf, "events")
    events.repartition(4).write.saveAsTable(name)
    target, checkpoint = fresh_path(spark, "events"), fresh_path(spark, "checkpoint")
    incremental.run_incremental(incremental.table_stream(spark, name, max_files=1), target, checkpoint, is_path=True)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(target).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("events"))
