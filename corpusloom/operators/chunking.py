"""From pages and documents to chunk tables, without leaving the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import markup, text as tx


def extract_pages(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Main text of each page; pages without an article are left out.

    The filter looks at the markup: one on the text would be pushed down and
    extract the text a second time.
    """
    return df.filter(markup.has_article(F.col(html))).withColumn(out, markup.html_to_text(F.col(html))).drop(html)


def chunk_documents(
    df: DataFrame,
    text: str = "text",
    id_cols: Sequence[str] = ("url",),
    max_tokens: int = tx.CHUNK_TOKENS,
    min_tokens: int = tx.MIN_CHUNK_TOKENS,
    overlap: int = tx.CHUNK_OVERLAP,
    boundaries: bool = True,
    counter: Callable[[Column], Column] = tx.token_count,
) -> DataFrame:
    """One row per chunk: ``id_cols, pos, content, n_tokens``.

    Images are removed, small neighbouring sections merged, large ones cut
    into overlapping windows (at text boundaries, or plainly with
    ``boundaries=False``), and chunks of ``min_tokens`` or fewer dropped. A
    narrow plan: one projection and one generate above the scan.
    """
    window = tx.counted_boundary_windows if boundaries else tx.counted_token_windows
    merged = tx.merge_sections(tx.strip_data_images(F.col(text)), max_tokens, counter)
    chunks = F.flatten(F.transform(merged, lambda s: window(s, max_tokens, overlap)))
    return _explode_chunks(df, chunks, id_cols, counter, min_tokens)


def chunk_windows(
    df: DataFrame,
    text: str = "text",
    id_cols: Sequence[str] = ("url",),
    max_tokens: int = tx.CHUNK_TOKENS,
    min_tokens: int = tx.MIN_CHUNK_TOKENS,
    overlap: int = tx.CHUNK_OVERLAP,
) -> DataFrame:
    """Plain windows over the whole text, for text without sections."""
    chunks = tx.counted_token_windows(F.col(text), max_tokens, overlap)
    return _explode_chunks(df, chunks, id_cols, tx.token_count, min_tokens)


def chunk_sentences(
    df: DataFrame,
    text: str = "text",
    id_cols: Sequence[str] = ("url",),
    size: int = tx.CHUNK_TOKENS,
    overlap: int = tx.SENTENCE_OVERLAP,
) -> DataFrame:
    """Chunks of whole sentences; texts that are null give none."""
    chunks = tx.counted_contents(tx.sentence_windows(F.col(text), size, overlap))
    return _explode_chunks(df, chunks, id_cols, tx.token_count, 0)


def _explode_chunks(
    df: DataFrame, chunks: Column, id_cols: Sequence[str], counter: Callable[[Column], Column], min_tokens: int
) -> DataFrame:
    # A null text has null chunks, of which explode makes no row.
    # Counting and filtering inside the array handles each chunk once; a filter
    # on a column made by a projection would be pushed down and count it again.
    # Windows bring their count in tokens; another counter has to look at the text.
    numbered = F.transform(
        chunks,
        lambda c, i: F.struct(
            i.alias("pos"),
            c["content"].alias("content"),
            (c["n_tokens"] if counter is tx.token_count else counter(c["content"])).alias("n_tokens"),
        ),
    )
    kept = F.filter(numbered, lambda c: c["n_tokens"] > min_tokens)
    return df.select(*id_cols, F.explode(kept).alias("__c")).select(*id_cols, "__c.*")
