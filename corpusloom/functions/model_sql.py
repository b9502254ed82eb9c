"""Model functions callable from SQL, backed by interchangeable models and rules.

``ai_query`` and ``ai_gen`` hand distinct prompts of each Arrow batch to a
backend. The others are the deterministic baselines of
:mod:`corpusloom.operators.baselines` in SQL form: rules and short word lists,
no replacement for a language model. For large tables prefer ``infer`` or, in
SQL, ``ai_request``, which ask each distinct prompt once over the whole table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.registry import SqlFunction, register_functions
from corpusloom.functions.text import TOKEN, WORD
from corpusloom.operators.baselines import MASK, PATTERNS

# A backend gets prompts and the response schema (JSON text, or None) and returns one reply each.
Backend = Callable[[list[str], str | None], Sequence[str]]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_map(pairs: dict, value: Callable[[object], str]) -> str:
    if not pairs:
        raise ValueError("empty word list")
    return "map(" + ", ".join(f"{_quoted(k)}, {value(v)}" for k, v in pairs.items()) + ")"


def batch_asker(backends: dict[str, Backend], batch_size: int):
    """Replies to a batch of prompts by endpoint and response format, each distinct prompt of it asked once."""

    def one_batch(endpoints: pd.Series, prompts: pd.Series, formats: pd.Series | None) -> pd.Series:
        frame = pd.DataFrame({"endpoint": endpoints, "prompt": prompts})
        frame["format"] = None if formats is None else formats
        out = pd.Series([None] * len(frame), index=frame.index, dtype=object)
        asked = frame[frame["prompt"].notna()]
        for (endpoint, form), rows in asked.groupby(["endpoint", "format"], dropna=False):
            if endpoint not in backends:
                raise ValueError(f"unknown endpoint {endpoint!r}")
            distinct = rows["prompt"].unique().tolist()
            replies: dict[str, str] = {}
            for start in range(0, len(distinct), batch_size):
                part = distinct[start : start + batch_size]
                got = list(backends[endpoint](part, None if pd.isna(form) else form))
                if len(got) != len(part):
                    raise ValueError(f"backend returned {len(got)} replies for {len(part)} prompts")
                replies.update(zip(part, got))
            out[rows.index] = rows["prompt"].map(replies)
        return out

    return one_batch


# Fixed value: words that a summary has at most unless told otherwise.
SUMMARY_WORDS = 50
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*|[.!?]+")
_WORD = re.compile(r"[^\W_]+")


def summary(text: str | None, most_words: int | None) -> str | None:
    """Sentences with the highest mean frequency of their words, in text order, up to a number of words; one at least."""
    if text is None:
        return None
    sentences = [s for s in (s.strip(" \t\r\n") for s in _SENTENCE.findall(text)) if s]
    words = [_WORD.findall(s.lower()) for s in sentences]
    counts = Counter(w for ws in words for w in ws)
    ranked = sorted((-round(sum(counts[w] for w in ws) / len(ws), 6), i) for i, ws in enumerate(words) if ws)
    chosen, held = [], 0
    for _, i in ranked:
        held += len(words[i])
        if chosen and held > (SUMMARY_WORDS if most_words is None else most_words):
            break
        chosen.append(i)
    return " ".join(sentences[i] for i in sorted(chosen))


def register_model_functions(
    spark: SparkSession,
    backends: dict[str, Backend] | None = None,
    generator: str | None = None,
    lexicon: dict[str, int] | None = None,
    glossaries: dict[str, dict[str, str]] | None = None,
    patterns: dict[str, str] | None = None,
    batch_size: int = 150,
) -> list[str]:
    """Create the functions in the session; returns their names.

    ``backends`` maps endpoint names to models; ``generator`` names the one
    behind ``ai_gen``. ``lexicon`` serves ``ai_analyze_sentiment``,
    ``glossaries`` (by target language) ``ai_translate``, and ``patterns``
    adds entity labels to the known ones. Functions whose input is missing
    are not created.
    """
    names: list[str] = []
    if backends:
        ask = batch_asker(backends, batch_size)

        @F.pandas_udf("string")
        def ai_query(endpoint: pd.Series, request: pd.Series, responseFormat: pd.Series = None) -> pd.Series:
            return ask(endpoint, request, responseFormat)

        # Not copied into filters on its parsed result, so that a model is not called twice.
        spark.udf.register("ai_query", ai_query.asNondeterministic())
        names.append("ai_query")
        if generator:

            @F.pandas_udf("string")
            def ai_gen(prompt: pd.Series) -> pd.Series:
                return ask(pd.Series(generator, index=prompt.index), prompt, None)

            spark.udf.register("ai_gen", ai_gen.asNondeterministic())
            names.append("ai_gen")

    @F.pandas_udf("string")
    def ai_summarize(content: pd.Series, max_words: pd.Series = None) -> pd.Series:
        limits = [None] * len(content) if max_words is None else [None if pd.isna(m) else int(m) for m in max_words]
        return pd.Series([summary(t, m) for t, m in zip(content, limits)], index=content.index, dtype=object)

    spark.udf.register("ai_summarize", ai_summarize)
    names.append("ai_summarize")

    known = {**PATTERNS, **(patterns or {})}
    # An unknown kind fails the query: a null pattern would make the whole text null.
    pattern_of = f"coalesce(try_element_at({_sql_map(known, _quoted)}, l), raise_error(concat('no pattern for ', l)))"
    words = f"regexp_extract_all(lower(%s), {_quoted(WORD)}, 0)"
    tokens = f"regexp_extract_all(lower(%s), {_quoted(TOKEN)}, 0)"
    functions = [
        SqlFunction(
            "ai_mask", "content STRING, labels ARRAY<STRING>", "STRING", "Mask entities of the given kinds.",
            f"aggregate(labels, content, (acc, l) -> regexp_replace(acc, {pattern_of}, '{MASK}'))",
        ),
        SqlFunction(
            "ai_extract", "content STRING, labels ARRAY<STRING>", "MAP<STRING, ARRAY<STRING>>",
            "Distinct entities of the given kinds, by label.",
            f"map_from_arrays(labels, transform(labels, l -> array_distinct(regexp_extract_all(content, {pattern_of}, 0))))",
        ),
        SqlFunction(
            "ai_similarity", "a STRING, b STRING", "DOUBLE", "Share of common tokens, between 0 and 1.",
            f"coalesce(try_divide(CAST(size(array_intersect({tokens % 'a'}, {tokens % 'b'})) AS DOUBLE), "
            f"size(array_union({tokens % 'a'}, {tokens % 'b'}))), 0D)",
        ),
        SqlFunction(
            "ai_classify", "content STRING, labels ARRAY<STRING>", "STRING",
            "The label whose words occur most often in the text, ties by place; null without a hit.",
            "get(transform(filter(sort_array(transform(labels, (l, i) -> named_struct("
            f"'n', -size(filter({words % 'content'}, w -> array_contains({words % 'l'}, w))), 'i', i, 'l', l))), "
            "x -> x.n < 0), x -> x.l), 0)",
        ),
        SqlFunction(
            "ai_fix_grammar", "content STRING", "STRING", "Rules for blanks, marks, doubled words and capitals.",
            "array_join(transform(regexp_extract_all(array_join(get(transform(array(split(regexp_replace(regexp_replace("
            r"content, '[ \\t]+', ' '), ' ([,.;:!?])', '$1'), ' ')), ws -> filter(ws, (w, i) -> i = 0 OR w = '' OR "
            r"lower(w) <> lower(get(ws, i - 1)))), 0), ' '), '\\s*[^.!?\\s][^.!?]*[.!?]*|\\s+|[.!?]+', 0), "
            r"s -> concat(regexp_extract(s, '^\\s*', 0), upper(substr(s, length(regexp_extract(s, '^\\s*', 0)) + 1, 1)), "
            r"substr(s, length(regexp_extract(s, '^\\s*', 0)) + 2))), '')",
        ),
    ]
    if lexicon:
        weight = f"coalesce(try_element_at({_sql_map(lexicon, str)}, w), 0)"
        functions.append(
            SqlFunction(
                "ai_analyze_sentiment", "content STRING", "STRING", "Sign of the summed word weights.",
                f"CASE signum(aggregate({words % 'content'}, 0, (acc, w) -> acc + {weight})) "
                "WHEN 1 THEN 'positive' WHEN -1 THEN 'negative' WHEN 0 THEN 'neutral' END",
            )
        )
    if glossaries:
        cases = " ".join(f"WHEN {_quoted(lang)} THEN {_sql_map(g, _quoted)}" for lang, g in glossaries.items())
        pieces = r"'[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+'"
        functions.append(
            SqlFunction(
                "ai_translate", "content STRING, to_lang STRING", "STRING", "Word-by-word translation; unknown words stay.",
                f"array_join(transform(regexp_extract_all(content, {pieces}, 0), "
                f"p -> coalesce(try_element_at(CASE to_lang {cases} END, lower(p)), p)), '')",
            )
        )
    return names + register_functions(spark, functions)
