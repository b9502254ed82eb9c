"""The corpus build from pages to an index table, put together from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom.operators.chunking import chunk_documents, extract_pages
from corpusloom.operators.embedding import Backend, build_index, embed
from corpusloom.sources.tables import with_chunk_id


def chunk_table(pages: DataFrame, **options) -> DataFrame:
    """``id, url, content`` chunks of raw pages (``url, html``)."""
    chunks = chunk_documents(extract_pages(pages), "text", ["url"], **options)
    return with_chunk_id(chunks).select("id", "url", "content")


def index_table(chunks: DataFrame, backend: Backend | None = None, dim: int = 1024) -> DataFrame:
    """``id, embedding, url, content`` rows of a chunk table."""
    return build_index(embed(chunks, "content", backend, dim), "id", "embedding", ["url", "content"], dim)
