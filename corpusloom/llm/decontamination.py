"""Benchmark decontamination by pigeonhole edit matching.

An item may occur in a document with up to ``budget`` edited characters. Cut
into ``budget`` + 1 pieces, at least one piece of such an occurrence is
untouched, so exact hits of pieces (one Aho-Corasick automaton for all items)
find every candidate. The text around a hit is verified with Myers'
bit-parallel edit distance. Letter case, punctuation and white space do not
count: both sides are compared as lower-case words joined by one space.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.texts import map_texts

WORD = r"\w+"
# Share of an item's characters that may be edited.
ERROR_RATE = 0.05
# Items with fewer words match on word borders only: as bare characters they would be found inside longer words.
FEWEST_WORDS = 8
# Characters of items that one automaton holds; larger benchmarks are searched for in several passes.
BLOCK_CHARS = 4 << 20


@dataclass(frozen=True)
class Item:
    item_id: int
    text: str
    budget: int


def normal(text: str) -> str:
    return " ".join(re.findall(WORD, text.lower()))


def item_blocks(items: DataFrame, item_id: str, item_text: str, rate: float, chars: int) -> Iterator[list[Item]]:
    """The items in blocks of bounded size; the driver holds one block at a time."""
    block, held = [], 0
    rows = items.select(item_id, item_text).filter(F.col(item_text).isNotNull()).toLocalIterator()
    for key, text in rows:
        clean = normal(text)
        if not clean:
            continue
        block.append(Item(key, clean, int(rate * len(clean))))
        held += len(clean)
        if held >= chars:
            yield block
            block, held = [], 0
    if block:
        yield block


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``id, item_id, distance, first_word, n_words``: each item that occurs in a whole text, with its closest place.

    ``first_word`` and ``n_words`` give the place in words (``\\w+``) of the
    document; of equally close places the first one counts. Items under
    ``FEWEST_WORDS`` words begin and end on word borders. Null and empty
    texts and items match nothing. Repeated documents or items each come with
    their own rows; null ids stay null. Documents are read once per block of
    items and never shuffled.
    """
    schema = (
        f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}, "
        f"item_id {items.schema[item_id].dataType.simpleString()}, distance int, first_word bigint, n_words bigint"
    )
    item_type = to_arrow_type(items.schema[item_id].dataType)
    found = [
        _search(docs, block, id_column, text_column, schema, item_type)
        for block in item_blocks(items, item_id, item_text, rate, block_chars)
    ]
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def contaminated_ids(matches: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return matches.select(id_column).distinct()


def flag_documents(
    docs: DataFrame, items: DataFrame, text_column: str = "text", flag: str = "contaminated", rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with a boolean column that is true where any item occurs; rows are neither joined nor shuffled."""
    out = docs.withColumn(flag, F.lit(False))
    for block in item_blocks(items, "item_id", "text", rate, block_chars):
        check = _occurs(block)
        out = out.withColumn(flag, F.col(flag) | F.coalesce(check(F.col(text_column)), F.lit(False)))
    return out


def _occurs(block: list[Item]):
    @F.arrow_udf("boolean")
    def check(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        search = Searcher(block)
        for texts in parts:
            yield pa.array([bool(search(t or "")) for t in texts.to_pylist()], pa.bool_())

    return check


def _search(docs: DataFrame, block: list[Item], id_column: str, text_column: str, schema: str, item_type: pa.DataType) -> DataFrame:
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        search = Searcher(block)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, out = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                for match in search(text or ""):
                    rows.append(row)
                    out.append(match)
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            item, distance, first, count = zip(*out, strict=True) if out else ((), (), (), ())
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(item, item_type), pa.array(distance, pa.int32()), pa.array(first, pa.int64()), pa.array(count, pa.int64())],
                [id_column, "item_id", "distance", "first_word", "n_words"],
            )

        return work

    return map_texts(docs, [id_column, text_column], text_column, make, schema)


class Searcher:
    """Finds the items of one block in a text."""

    def __init__(self, items: list[Item]) -> None:
        import ahocorasick

        self.items = items
        self.whole = [item.text.count(" ") + 1 < FEWEST_WORDS for item in items]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, item in enumerate(items):
            if self.whole[n] and not item.budget:
                # With its borders an item is met once per occurrence, not in every word that holds it.
                pieces.setdefault(f" {item.text} ", []).append((n, -1))
                continue
            parts, size = item.budget + 1, len(item.text)
            for k in range(parts):
                a, b = k * size // parts, (k + 1) * size // parts
                pieces.setdefault(item.text[a:b], []).append((n, a))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()
        self.any = bool(pieces)
        self.masks: dict[int, dict[str, int]] = {}

    def __call__(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, first word, words) per item found."""
        clean = normal(text)
        out: list[tuple[int, int, int, int]] = []
        if not self.any or not clean:
            return out
        best: dict[int, tuple[int, int, int]] = {}
        tried: dict[int, int] = {}
        # The text has a border on either side, so its places are one less than those of the hits.
        for last, (size, places) in self.automaton.iter(f" {clean} "):
            for n, offset in places:
                item = self.items[n]
                start = last - size - offset
                # The window verified last already holds every match that this hit can belong to.
                if n in tried and abs(start - tried[n]) <= item.budget:
                    continue
                if n in best and best[n][0] == 0:
                    continue
                tried[n] = start
                if self.whole[n]:
                    found = self.between_borders(n, clean, start)
                    if found and (n not in best or found[0] < best[n][0]):
                        best[n] = found
                    continue
                low = max(0, start - 2 * item.budget)
                window = clean[low : start + len(item.text) + 3 * item.budget]
                distance, end = self.verify(n, window)
                if distance <= item.budget and (n not in best or distance < best[n][0]):
                    best[n] = (distance, low, low + end)
        for n, (distance, low, end) in best.items():
            item = self.items[n]
            begin = low if self.whole[n] else self.begin(n, clean[low:end], distance) + low
            out.append((item.item_id, distance, clean.count(" ", 0, begin), clean.count(" ", begin, end) + 1))
        return out

    def verify(self, n: int, window: str) -> tuple[int, int]:
        if n not in self.masks:
            self.masks[n] = bit_masks(self.items[n].text)
        return myers(self.masks[n], len(self.items[n].text), window)

    def between_borders(self, n: int, clean: str, start: int) -> tuple[int, int, int] | None:
        """(distance, begin, end) of the closest run of whole words that begins around ``start``."""
        item, best = self.items[n], None
        if n not in self.masks:
            self.masks[n] = bit_masks(item.text)
        for begin in range(max(0, start - 2 * item.budget), min(len(clean), start + 2 * item.budget + 1)):
            if begin and clean[begin - 1] != " ":
                continue
            # One character more than a match can have shows whether its last one ends a word.
            stretch = clean[begin : begin + len(item.text) + item.budget + 1]
            distance, length = myers(self.masks[n], len(item.text), stretch, anchored=True, borders=True)
            if distance <= item.budget and (best is None or distance < best[0]):
                best = (distance, begin, begin + length)
        return best

    def begin(self, n: int, stretch: str, distance: int) -> int:
        """Where a match that ends with ``stretch`` begins: the same search, backwards."""
        text = self.items[n].text
        _, length = myers(bit_masks(text[::-1]), len(text), stretch[::-1], anchored=True)
        return len(stretch) - length


def bit_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(masks: dict[str, int], size: int, text: str, anchored: bool = False, borders: bool = False) -> tuple[int, int]:
    """Least edit distance of the pattern to a stretch of ``text``, and the end of the first such stretch.

    Myers' bit-vector recurrence with the whole pattern in one integer. With
    ``anchored`` the stretch starts with the text; otherwise anywhere. With
    ``borders`` it ends before a space or with the text.
    """
    full, high = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best, end = size, 0
    for i, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | ~(xh | up) & full
        mh = up & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = ph << 1 & full | anchored
        mh = mh << 1 & full
        up = mh | ~(xv | ph) & full
        down = ph & xv
        if score < best and (not borders or text[i + 1 : i + 2] in ("", " ")):
            best, end = score, i + 1
    return best, end
