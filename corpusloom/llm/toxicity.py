"""Toxicity: a word classifier that is regularised with counterfactual texts.

Logistic regression on the words of a text and on how its words begin, so that
inflected forms that training never saw count as well. In every training text that names
a group, the group terms are also swapped for other terms of the same kind;
the training penalises the difference between the scores of the text and of
its swapped form, so that the name of a group by itself moves no score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.texts import map_texts

WORD = r"[^\W\d_]+"
# Lengths of the word beginnings that are features beside whole words; they are written with a leading mark.
BEGINNINGS = (4, 5, 6)
MARK = "^"

# Terms that name groups of people, by kind; terms are swapped within their kind.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer", "heterosexual"),
    ("blind", "deaf", "disabled", "autistic"),
    ("old", "young", "elderly", "teenage"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
)


@dataclass(frozen=True)
class Training:
    """Bounds and weights of the fit.

    The model is fitted on at most ``sample_rows`` labelled rows, chosen by a
    hash of their id. At most ``features`` features are kept: those whose
    presence differs most between the labels, by the z-score of their log odds,
    and by ``least_z`` at least.
    """

    sample_rows: int = 8000
    features: int = 512
    least_rows: int = 5
    least_z: float = 4.0
    rounds: int = 400
    rate: float = 0.1
    ridge: float = 3e-4
    counterfactual: float = 1.0
    terms: Sequence[Sequence[str]] = field(default=IDENTITY_TERMS)


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        found = features(set(re.findall(WORD, (text or "").lower()))).intersection(self.weights)
        z = self.bias + math.fsum(self.weights[f] for f in found)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def features(words: Iterable[str]) -> set[str]:
    out = set(words)
    for size in BEGINNINGS:
        out.update([MARK + w[:size] for w in words if len(w) >= size])
    return out


def held_out(id_column: str) -> F.Column:
    """Rows that no label may be learnt from: crc32 of the id as text leaves 2 on division by 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label: str, rows: int) -> DataFrame:
    """``text, label`` of a bounded sample of labelled rows outside the held-out quarter.

    The ids are chosen from the narrow label table first, so texts are neither
    shuffled nor collected beyond the sample; that choice, at most ``rows`` ids,
    is what is broadcast. An id with several labels takes the greatest.
    """
    chosen = (
        labels.filter(F.col(id_column).isNotNull() & F.col(label).isNotNull() & ~held_out(id_column))
        .groupBy(id_column)
        .agg(F.max(label).alias("__label"))
        .orderBy(F.xxhash64(F.lit("toxicity"), F.col(id_column)), id_column)
        .limit(rows)
    )
    return docs.select(id_column, text_column).join(F.broadcast(chosen), id_column).select(
        F.col(text_column).alias("text"), F.col("__label").cast("int").alias("label")
    )


def fit(sample: DataFrame, training: Training = Training()) -> Model:
    """Fit on the driver from the words that each sampled text contains, which the tasks extract."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = [sorted(set(re.findall(WORD, (t or "").lower()))) for t in batch.column(0).to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), batch.column(1)], ["words", "label"])

        return work

    table = map_texts(sample, ["text", "label"], "text", make, "words array<string>, label int").toArrow()
    rows = sorted(zip(shared_words(table["words"]), table["label"].to_pylist(), strict=True))
    return fit_words([w for w, _ in rows], np.array([y for _, y in rows], float), training)


def shared_words(column: pa.ChunkedArray) -> list[list[str]]:
    """The lists of the column, with one string object per distinct word."""
    lists = column.combine_chunks()
    flat = lists.flatten().dictionary_encode()
    known, at = flat.dictionary.to_pylist(), flat.indices.to_pylist()
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(int).tolist()
    return [[known[i] for i in at[a:b]] for a, b in zip([0, *ends], ends)]


def fit_words(texts: list[list[str]], labels: np.ndarray, training: Training = Training()) -> Model:
    """Without both labels present the model is a constant: the share of label 1, or 0.5 without rows."""
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.5
        odds = (share * len(labels) + 0.5) / ((1 - share) * len(labels) + 0.5)
        return Model({}, math.log(odds))
    kinds = {term: (k, n) for k, terms in enumerate(training.terms) for n, term in enumerate(terms)}
    column = {f: j for j, f in enumerate(telling_features(texts, labels, training, set(kinds)))}
    row, col = pairs(texts, column)
    swapped = [swap(words, training.terms, kinds) for words in texts]
    changed = [i for i, words in enumerate(swapped) if words is not None]
    there = pairs([texts[i] for i in changed], column)
    here = pairs([swapped[i] for i in changed], column)
    params = np.zeros(len(column) + 1)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, training.rounds + 1):
        w, b = params[:-1], params[-1]
        z = b + np.bincount(row, w[col], len(texts))
        error = (1 / (1 + np.exp(-z)) - labels) / len(labels)
        grad = np.append(np.bincount(col, error[row], len(column)) + training.ridge * w, error.sum())
        if changed:
            gap = np.bincount(there[0], w[there[1]], len(changed)) - np.bincount(here[0], w[here[1]], len(changed))
            gap *= 2 * training.counterfactual / len(changed)
            grad[:-1] += np.bincount(there[1], gap[there[0]], len(column)) - np.bincount(here[1], gap[here[0]], len(column))
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        params -= training.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model({w: float(params[j]) for w, j in column.items()}, float(params[-1]))


def telling_features(texts: list[list[str]], labels: np.ndarray, training: Training, always: set[str]) -> list[str]:
    counts = (Counter(), Counter())
    for words, y in zip(texts, labels, strict=True):
        counts[int(y)].update(features(words))
    n1, n0 = labels.sum(), len(labels) - labels.sum()

    def z_score(feature: str) -> float:
        a, b = counts[1][feature] + 0.5, counts[0][feature] + 0.5
        odds = math.log(a / (n1 - a + 1)) - math.log(b / (n0 - b + 1))
        return abs(odds) / math.sqrt(1 / a + 1 / b)

    seen = [f for f in counts[0] | counts[1] if counts[0][f] + counts[1][f] >= training.least_rows and f not in always]
    ranked = sorted((-z, f) for f in seen if (z := z_score(f)) >= training.least_z)
    return [f for _, f in ranked[: training.features]] + sorted(w for w in always if counts[0][w] + counts[1][w])


def pairs(texts: list[list[str]], column: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    found = [(i, column[f]) for i, words in enumerate(texts) for f in sorted(features(words).intersection(column))]
    at = np.array(found, np.int64).reshape(-1, 2)
    return at[:, 0], at[:, 1]


def swap(words: list[str], terms: Sequence[Sequence[str]], kinds: dict[str, tuple[int, int]]) -> list[str] | None:
    """The words with each group term replaced by the next of its kind; None where no group is named."""
    if not any(w in kinds for w in words):
        return None
    return sorted({terms[kinds[w][0]][(kinds[w][1] + 1) % len(terms[kinds[w][0]])] if w in kinds else w for w in words})


def score_texts(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, score`` of every whole text, one row per row; null and empty texts get the score of no words.

    Only the text enters a score. Other columns are ignored, null ids and
    repeated rows stay. One pass, no shuffle.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [model.score(t) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [id_column, "score"])

        return work

    return map_texts(docs, [id_column, text_column], text_column, make, f"`{id_column}` {kind}, score double")


def score_column(model: Model, text: F.Column) -> F.Column:
    """The score as a Column, for filters that keep whole rows."""

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t) for t in texts.to_pylist()], pa.float64())

    return scores(text)
