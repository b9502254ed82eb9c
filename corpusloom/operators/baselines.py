"""Deterministic stand-ins for model-backed text functions.

They let the jobs around a model run and be tested without one. They are rules
and word lists, and no replacement for a language model.
"""

from __future__ import annotations

from collections.abc import Sequence

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import let, runs, sentences, tokens, words
from corpusloom.operators.relational import nearest_term
from corpusloom.plans.skew import skew_join

__all__ = [
    "PATTERNS",
    "classify",
    "extract",
    "fix_grammar",
    "mask_entities",
    "mask_terms",
    "nearest_term",
    "sentiment",
    "similarity",
    "summarize",
    "terms_pattern",
    "translate",
]

# Patterns of the entity kinds known without a word list.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "ip_address": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "phone": r"\+[0-9][0-9 ()-]{7,}[0-9]",
    "url": r"https?://[^\s<>]+",
    "address": r"\b[0-9]+ [A-Z][A-Za-z]+ (?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd)\b",
    "person": r"\b(?:Mr|Mrs|Ms|Dr)\. [A-Z][a-z]+\b",
}
MASK = "[MASKED]"


def terms_pattern(terms: Sequence[str]) -> str:
    """Pattern matching any of the terms, longest first; long lists are faster as a table (translate, nearest_term)."""
    return r"\b(?:" + "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True)) + r")\b"


def _word_counts(df: DataFrame, id_cols: Sequence[str], col: str) -> DataFrame:
    """``id_cols, word, n``: the distinct words of each row with their counts; one row with a null word where there are none."""
    counted = let(
        F.sort_array(words(F.col(col))),
        lambda ws: runs(ws, lambda p, n: F.struct(F.get(ws, p).alias("word"), n.cast("long").alias("n"))),
    )
    return df.select(*id_cols, F.explode_outer(counted).alias("__w")).select(*id_cols, "__w.word", "__w.n")


def sentiment(df: DataFrame, id_cols: Sequence[str], col: str, lexicon: DataFrame) -> DataFrame:
    """``id_cols, score, sentiment`` from a table of ``word, weight``; rows with equal ids (nulls too) are one text.

    Words are counted within the row and joined with the lexicon, whatever its
    size; the partial sums of a row are added up in its task, so one small row
    per text is shuffled and never the text. Weights keep their type.
    """
    weights = lexicon.filter("word is not null").groupBy("word").agg(F.sum("weight").alias("weight"))
    scored = (
        skew_join(_word_counts(df, id_cols, col), weights, ["word"])
        .groupBy(*id_cols)
        .agg(F.coalesce(F.sum(F.col("weight") * F.col("n")), F.lit(0)).alias("score"))
    )
    name = F.when(F.col("score") > 0, "positive").when(F.col("score") < 0, "negative").otherwise("neutral")
    return scored.withColumn("sentiment", name)


def classify(df: DataFrame, id_cols: Sequence[str], col: str, keywords: DataFrame) -> DataFrame:
    """Label with most keyword hits (``label, word`` table), ties by label; null without a hit."""
    scored = (
        skew_join(_word_counts(df, id_cols, col), keywords.select("label", "word"), ["word"])
        .groupBy(*id_cols, "label")
        .agg(F.sum(F.when(F.col("label").isNotNull(), F.col("n")).otherwise(0)).alias("hits"))
    )
    best = F.min(F.struct((-F.col("hits")).alias("n"), F.col("label").isNull().alias("none"), "label")).alias("__best")
    return scored.groupBy(*id_cols).agg(best).select(*id_cols, "__best.label", (-F.col("__best.n")).alias("hits"))


def extract(df: DataFrame, col: str, patterns: dict[str, str], out: str = "entities") -> DataFrame:
    """Struct with the distinct matches of each label's pattern, in order of appearance."""
    found = [
        F.array_distinct(F.regexp_extract_all(F.col(col), F.lit(p), F.lit(0))).alias(label)
        for label, p in patterns.items()
    ]
    return df.withColumn(out, F.struct(*found))


def mask_entities(col: Column, labels: Sequence[str] | dict[str, str]) -> Column:
    """Replace entities by ``[MASKED]``; labels name known patterns or bring their own."""
    patterns = labels if isinstance(labels, dict) else {name: PATTERNS[name] for name in labels}
    for pattern in patterns.values():
        col = F.regexp_replace(col, pattern, F.lit(MASK))
    return col


def mask_terms(df: DataFrame, id_cols: Sequence[str], col: str, terms: DataFrame, term: str = "term") -> DataFrame:
    """``id_cols, translation``: the terms of a gazetteer table of any size (names, places) replaced by ``[MASKED]``.

    A term of several words is masked where all of them stand together; letter case does not count.
    """
    return replace_phrases(df, id_cols, col, terms.select(F.col(term).alias("source"), F.lit(MASK).alias("target")))


def _phrase(text: Column) -> Column:
    """A phrase as it is compared: lower case, one blank for any white space."""
    return F.regexp_replace(F.lower(text), r"\s+", " ")


def replace_phrases(df: DataFrame, id_cols: Sequence[str], col: str, phrases: DataFrame) -> DataFrame:
    """``id_cols, translation``: phrases of a table of ``source, target`` replaced; of those that meet, the leftmost, then longest.

    A phrase begins and ends at word borders; case and kind of white space do
    not count. Only words that begin a phrase are taken from a text, with as
    many words after them as such phrases have; these short pieces meet the
    table, whatever its size, and never the text. Spans come back as one list
    per text; rows with equal ids (nulls too) share it, so ids name texts.
    """
    ids = list(id_cols)
    pieces_of = F.regexp_extract_all(F.col(col), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    bare = F.regexp_extract(F.col("source"), r"[\p{L}\p{N}](?:.*[\p{L}\p{N}])?", 0)
    known = (
        phrases.select(_phrase(bare).alias("phrase"), "target")
        .filter("phrase <> ''")
        .groupBy("phrase")
        .agg(F.min("target").alias("target"))
        .withColumn("pieces", F.size(F.regexp_extract_all("phrase", F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))))
    )
    # How many pieces the phrases that begin with a word have; a few numbers for each word.
    begins = known.groupBy(F.regexp_extract("phrase", r"^[\p{L}\p{N}]+", 0).alias("word")).agg(F.collect_set("pieces").alias("sizes"))
    vocabulary = df.select(*ids, F.explode(F.array_distinct(words(F.col(col)))).alias("word"))
    starts = (
        skew_join(vocabulary, begins, ["word"], "inner")
        .groupBy(*[F.col(c).alias(f"__id{n}") for n, c in enumerate(ids)])
        .agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("word", "sizes")))).alias("__starts"))
    )
    same = F.lit(True)
    for n, c in enumerate(ids):
        same = same & F.col(c).eqNullSafe(F.col(f"__id{n}"))
    held = df.join(starts, same, "inner").select(*ids, F.col(col).alias("__text"), "__starts")

    def tried(pieces: Column) -> Column:
        """(place, pieces, phrase) of whatever a text may hold, computed within its row."""
        found = F.transform(
            pieces,
            lambda p, i: F.transform(
                F.coalesce(F.try_element_at("__starts", F.lower(p)), F.array().cast("array<int>")),
                lambda n: F.struct(i.alias("at"), n.alias("pieces"), _phrase(F.array_join(F.slice(pieces, i + 1, n), "")).alias("phrase")),
            ),
        )
        return F.flatten(found)

    text_pieces = F.regexp_extract_all("__text", F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    candidates = held.select(*ids, F.inline(let(text_pieces, tried)))
    met = skew_join(candidates, known.select("phrase", "target"), ["phrase"], "inner")
    spans = (
        met.groupBy(*[F.col(c).alias(f"__id{n}") for n, c in enumerate(ids)])
        .agg(F.sort_array(F.collect_set(F.struct("at", (-F.col("pieces")).alias("less"), "target"))).alias("__met"))
    )
    # Leftmost first, longest of those: a span is kept if it begins behind the last one that was.
    empty = F.struct(F.lit(-1).alias("end"), F.array().cast("array<struct<at:int,pieces:int,target:string>>").alias("kept"))
    kept = F.aggregate(
        "__met",
        empty,
        lambda s, m: F.when(
            m["at"] > s["end"],
            F.struct(
                (m["at"] - m["less"] - 1).alias("end"),
                F.concat(s["kept"], F.array(F.struct(m["at"].alias("at"), (-m["less"]).alias("pieces"), m["target"].alias("target")))).alias("kept"),
            ),
        ).otherwise(s),
        lambda s: s["kept"],
    )
    chosen = spans.withColumn("__kept", kept).drop("__met")

    def rewritten(pieces: Column) -> Column:
        """What stands before each kept span and what replaces it, then the rest: every piece is touched once."""
        spans = F.col("__kept")
        begin = lambda i: F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["at"] + F.get(spans, i - 1)["pieces"])
        parts = F.transform(
            spans, lambda k, i: F.concat(F.array_join(F.slice(pieces, begin(i) + 1, k["at"] - begin(i)), ""), k["target"])
        )
        rest = F.array_join(F.slice(pieces, begin(F.size(spans)) + 1, F.size(pieces)), "")
        return F.concat(F.array_join(parts, ""), rest)

    return df.join(chosen, same, "left").select(
        *ids, F.when(F.col("__kept").isNull(), F.col(col)).otherwise(let(pieces_of, rewritten)).alias("translation")
    )


def fix_grammar(col: Column) -> Column:
    """Rewrite rules in a fixed order: blanks, marks, doubled words, capitals."""
    col = F.regexp_replace(col, r"[ \t]+", " ")
    col = F.regexp_replace(col, r" ([,.;:!?])", "$1")
    single = F.array_join(
        let(
            F.split(col, " "),
            lambda ws: F.filter(
                ws,
                lambda w, i: (i == 0) | (w == "") | (F.lower(w) != F.lower(F.get(ws, i - 1))),
            ),
        ),
        " ",
    )
    pieces = F.regexp_extract_all(single, F.lit(r"\s*[^.!?\s][^.!?]*[.!?]*|\s+|[.!?]+"), F.lit(0))
    capital = F.transform(
        pieces,
        lambda s: let(
            F.length(F.regexp_extract(s, r"^\s*", 0)),
            lambda n: F.concat(
                F.substr(s, F.lit(1), n), F.upper(F.substr(s, n + 1, F.lit(1))), F.substr(s, n + 2)
            ),
        ),
    )
    return F.array_join(capital, "")


def similarity(a: Column, b: Column) -> Column:
    """Struct of two likenesses in [0, 1]: ``jaccard`` of token sets and ``cosine`` of token counts.

    The tokens of both texts are sorted together and counted in runs, so a
    pair costs n log n in its length. Without tokens the likeness is 0.
    """

    def tagged(text: Column, side: int) -> Column:
        return F.transform(tokens(F.lower(text)), lambda t: F.struct(t.alias("t"), F.lit(side).alias("side")))

    def count_runs(pool: Column) -> Column:
        return runs(
            pool,
            lambda p, n: F.struct(
                F.get(pool, p)["t"].alias("t"), F.get(pool, p)["side"].alias("side"), n.cast("double").alias("n")
            ),
        )

    def total(counts: Column, value) -> Column:
        return F.aggregate(F.transform(counts, value), F.lit(0.0), lambda acc, x: acc + x)

    def score(counts: Column) -> Column:
        # In sorted order a token's run of side 0 stands right before its run of side 1.
        def pair(r: Column, j: Column, value: Column) -> Column:
            after = F.get(counts, j + 1)
            return F.when((r["side"] == 0) & (after["t"] == r["t"]), value).otherwise(F.lit(0.0))

        shared = total(counts, lambda r, j: pair(r, j, F.lit(1.0)))
        product = total(counts, lambda r, j: pair(r, j, r["n"] * F.get(counts, j + 1)["n"]))

        def square(side: int) -> Column:
            return total(counts, lambda r: F.when(r["side"] == side, r["n"] * r["n"]).otherwise(F.lit(0.0)))

        jaccard = let(shared, lambda s: F.try_divide(s, F.size(counts) - s))
        cosine = F.try_divide(product, F.sqrt(square(0) * square(1)))
        return F.struct(
            F.coalesce(jaccard, F.lit(0.0)).alias("jaccard"), F.coalesce(cosine, F.lit(0.0)).alias("cosine")
        )

    pool = F.sort_array(F.concat(tagged(a, 0), tagged(b, 1)))
    return let(pool, lambda p: let(count_runs(p), score))


def summarize(col: Column, n: int = 2) -> Column:
    """The ``n`` sentences with the highest mean term frequency, in text order.

    Computed within the row, so no text is shuffled: the words are sorted to
    count them in runs, and sorted by sentence to average their counts.
    """

    def frequencies(pairs: Column) -> Column:
        """(sentence, frequency of the word) for every word, from pairs sorted by word."""
        return F.flatten(
            runs(
                pairs,
                lambda p, size: F.transform(
                    F.slice(pairs, p + 1, size), lambda w: F.struct(w["pos"].alias("pos"), size.alias("tf"))
                ),
                lambda a, b: a["word"] == b["word"],
            )
        )

    def scores(found: Column) -> Column:
        """Sentences as (minus score, place), to be sorted; from pairs sorted by sentence."""

        def mean(p: Column, size: Column) -> Column:
            total = F.aggregate(F.slice(found, p + 1, size), F.lit(0.0), lambda acc, w: acc + w["tf"])
            return F.struct((-F.round(total / size, 6)).alias("score"), F.get(found, p)["pos"].alias("pos"))

        return runs(found, mean, lambda a, b: a["pos"] == b["pos"])

    def pick(all_sentences: Column) -> Column:
        pairs = F.flatten(
            F.transform(
                all_sentences,
                lambda s, i: F.transform(words(s), lambda w: F.struct(w.alias("word"), i.alias("pos"))),
            )
        )
        ranked = let(
            F.sort_array(pairs), lambda ps: let(F.sort_array(frequencies(ps)), lambda found: F.sort_array(scores(found)))
        )
        places = F.sort_array(F.transform(F.slice(ranked, 1, n), lambda s: s["pos"]))
        return F.array_join(F.transform(places, lambda i: F.get(all_sentences, i)), " ")

    return let(sentences(col), pick)


def translate(df: DataFrame, id_cols: Sequence[str], col: str, glossary: DataFrame) -> DataFrame:
    """``id_cols, translation`` word by word from a table of ``source, target``; unknown words stay.

    Blanks and marks are kept. The distinct words of each row are joined with
    the glossary, whatever its size, and come back as a small map; rows with
    equal ids (nulls too) share one. Every row of ``df`` gives a row.
    """
    ids = list(id_cols)
    entries = glossary.filter("source is not null").groupBy("source").agg(F.min("target").alias("target"))
    # Words and the text between them, in turn.
    pieces = F.regexp_extract_all(F.col(col), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    vocabulary = df.select(*ids, F.explode(F.array_distinct(words(F.col(col)))).alias("source"))
    found = (
        skew_join(vocabulary, entries, ["source"], "inner")
        .groupBy(*[F.col(c).alias(f"__id{n}") for n, c in enumerate(ids)])
        .agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("source", "target")))).alias("__map"))
    )
    same = F.lit(True)
    for n, c in enumerate(ids):
        same = same & F.col(c).eqNullSafe(F.col(f"__id{n}"))
    translated = F.array_join(
        F.transform(pieces, lambda p: F.coalesce(F.try_element_at("__map", F.lower(p)), p)), ""
    )
    return df.join(found, same, "left").select(
        *ids, F.when(F.col("__map").isNull(), F.col(col)).otherwise(translated).alias("translation")
    )
