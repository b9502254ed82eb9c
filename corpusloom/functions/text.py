"""Token, section and window functions, all evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of letters and digits, or one other visible character.
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
# The same with its leading white space, so that joined tokens give the text back.
SPACED_TOKEN = r"\s*(?:[\p{L}\p{N}]+|[^\s\p{L}\p{N}])"
WORD = r"[\p{L}\p{N}]+"
BLANKS = " \t\r\n"

# Chunk bounds in tokens.
CHUNK_TOKENS = 500
CHUNK_OVERLAP = 50
MIN_CHUNK_TOKENS = 20
SENTENCE_OVERLAP = 10


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    Lambda bodies are not subject to common-subexpression elimination, so an
    expression repeated in them would be evaluated for every element.
    """
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def run_starts(values: Column, same: Callable[[Column, Column], Column] | None = None) -> Column:
    """0-based places where a new run begins in a sorted array."""
    differs = (lambda a, b: a != b) if same is None else (lambda a, b: ~same(a, b))
    places = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)))
    return F.filter(
        places,
        lambda i: (F.size(values) > 0) & ((i == 0) | differs(F.get(values, i), F.get(values, i - 1))),
    )


def runs(values: Column, body: Callable[[Column, Column], Column], same=None) -> Column:
    """``body(first place, length)`` for every run of a sorted array."""
    return let(
        run_starts(values, same),
        lambda starts: F.transform(
            starts, lambda p, j: body(p, F.coalesce(F.get(starts, j + 1), F.size(values)) - p)
        ),
    )


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def spaced_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SPACED_TOKEN), F.lit(0))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN))


def sentences(text: Column) -> Column:
    """Sentences with their end marks; a line break also ends a sentence."""
    found = F.regexp_extract_all(text, F.lit(r"[^.!?\n]+[.!?]*|[.!?]+"), F.lit(0))
    return F.filter(F.transform(found, strip), lambda s: s != "")


def strip_data_images(text: Column) -> Column:
    """Remove base64 images embedded in the text."""
    # Fixed value: pattern of an inline image.
    return F.regexp_replace(text, r"data:image/[a-zA-Z]+;base64,[A-Za-z0-9+/=\n]+", "")


def heading_sections(text: Column) -> Column:
    """Second-level sections as ``array<struct<heading, body>>``.

    Text before the first heading has an empty heading. Sections without a
    body are left out. ``## `` inside a fenced block does not start a section:
    the text is cut before each fence line, which makes every second piece the
    inside of a fence, and headings in those pieces are hidden from the split.
    """
    mark = "\u0001"
    pieces = F.split(F.concat(F.lit("\n"), text), r"(?m)(?=^[ \t]*(?:```|~~~))")
    shielded = F.array_join(
        F.transform(
            pieces,
            lambda p, i: F.when(i % 2 == 1, F.replace(p, F.lit("\n## "), F.lit(f"\n{mark}## "))).otherwise(p),
        ),
        "",
    )

    def section(piece: Column, i: Column) -> Column:
        first_line = F.substring_index(piece, "\n", 1)
        heading = F.when(i == 0, F.lit("")).otherwise(F.trim(first_line))
        rest = F.when(i == 0, piece).otherwise(F.substr(piece, F.length(first_line) + F.lit(2)))
        return F.struct(heading.alias("heading"), F.replace(strip(rest), F.lit(mark), F.lit("")).alias("body"))

    return F.filter(F.transform(F.split(shielded, "\n## "), section), lambda s: s["body"] != "")


def merge_sections(
    text: Column,
    max_tokens: int = CHUNK_TOKENS,
    counter: Callable[[Column], Column] = token_count,
) -> Column:
    """Join neighbouring small sections while they fit half the bound.

    A section that does not fit closes the running text and opens a new one.
    The fold carries a running count, so no text is counted twice.
    """

    def state(out: Column, prev: Column, n: Column) -> Column:
        return F.struct(out.alias("out"), prev.alias("prev"), n.cast("int").alias("n"))

    def close(acc: Column) -> Column:
        done = strip(acc["prev"])
        return F.when(done == "", acc["out"]).otherwise(F.concat(acc["out"], F.array(done)))

    def step(acc: Column, sec: Column) -> Column:
        content = F.concat(sec["heading"], F.lit("\n"), sec["body"], F.lit("\n"))
        return F.when(
            acc["n"] + sec["n"] <= max_tokens / 2,
            state(acc["out"], F.concat(acc["prev"], content), acc["n"] + sec["n"]),
        ).otherwise(state(close(acc), content, sec["n"]))

    counted = F.transform(
        heading_sections(text),
        lambda s: F.struct(
            s["heading"].alias("heading"),
            s["body"].alias("body"),
            (counter(s["heading"]) + counter(s["body"])).alias("n"),
        ),
    )
    none = F.array().cast("array<string>")
    merged = F.aggregate(counted, state(none, F.lit(""), F.lit(0)), step, close)
    # A text without headings is one section and needs no counting.
    plain = ~F.contains(F.concat(F.lit("\n"), text), F.lit("\n## "))
    whole = let(strip(text), lambda t: F.when(t == "", none).otherwise(F.array(t)))
    return F.when(plain, whole).otherwise(merged)


# Windows come with their token counts, which the cut knows without matching again.
COUNTED = "array<struct<content:string,n_tokens:int>>"


def _window(toks: Column, start: Column, length: Column) -> Column:
    return let(
        F.slice(toks, start + 1, length),
        lambda w: F.struct(strip(F.array_join(w, "")).alias("content"), F.size(w).alias("n_tokens")),
    )


def contents(counted: Column) -> Column:
    return F.transform(counted, lambda w: w["content"])


def counted_contents(texts: Column) -> Column:
    return F.transform(texts, lambda c: F.struct(c.alias("content"), token_count(c).alias("n_tokens")))


def token_windows(text: Column, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> Column:
    """Windows of ``size`` tokens, each starting ``size - overlap`` after the last."""
    return contents(counted_token_windows(text, size, overlap))


def counted_token_windows(text: Column, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> Column:
    """:func:`token_windows` as structs of content and token count."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")

    def cut(toks: Column) -> Column:
        last_start = F.greatest(F.size(toks) - F.lit(overlap + 1), F.lit(0))
        starts = F.sequence(F.lit(0), last_start, F.lit(size - overlap))
        windows = F.transform(starts, lambda i: _window(toks, i, F.lit(size)))
        return F.when(F.size(toks) == 0, F.array().cast(COUNTED)).when(F.size(toks) > 0, windows)

    return let(spaced_tokens(text), cut)


def boundary_windows(text: Column, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> Column:
    """Windows that end at a paragraph, line or word break where one is near.

    The break is searched in the second half of each window: the last blank
    line, else the last line break, else the last space; without any, the
    window ends at its bound. Every window therefore moves on by more than
    ``size / 2 - overlap`` tokens.
    """
    return contents(counted_boundary_windows(text, size, overlap))


def counted_boundary_windows(text: Column, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> Column:
    """:func:`boundary_windows` as structs of content and token count."""
    half = size // 2
    if not 0 <= overlap < half:
        raise ValueError("overlap must be smaller than half the size")
    pace = half - overlap + 1

    def cut(toks: Column) -> Column:
        n = F.size(toks)

        def state(out: Column, start: Column) -> Column:
            return F.struct(out.alias("out"), start.cast("int").alias("start"))

        def last_break(region: Column, opens: Callable[[Column], Column]) -> Column:
            return F.array_max(F.transform(region, lambda t, i: F.when(opens(t), i)))

        # A token brings the white space before it. The plain search comes first, as most tokens fail it.
        def after_line(t: Column) -> Column:
            return F.contains(t, F.lit("\n"))

        def after_paragraph(t: Column) -> Column:
            return after_line(t) & t.rlike(r"\n[ \t\r]*\n")

        def after_space(t: Column) -> Column:
            return F.left(t, F.lit(1)).isin(" ", "\t", "\n", "\r", "\f")

        def step(acc: Column, _: Column) -> Column:
            start = acc["start"]
            region = F.slice(toks, start + F.lit(half + 2), size - half)
            # Element i of the region would open the next window at start + half + 1 + i.
            snapped = F.coalesce(
                last_break(region, after_paragraph),
                last_break(region, after_line),
                last_break(region, after_space),
            )
            end = F.when(start + size >= n, n).otherwise(
                start + F.coalesce(snapped + F.lit(half + 1), F.lit(size))
            )
            moved = let(
                end,
                lambda e: state(
                    F.concat(acc["out"], F.array(_window(toks, start, e - start))),
                    F.when(e >= n, n).otherwise(e - overlap),
                ),
            )
            return F.when(start >= n, acc).otherwise(moved)

        rounds = F.sequence(F.lit(0), F.floor(n / F.lit(pace)).cast("int"))
        return F.aggregate(rounds, state(F.array().cast(COUNTED), F.lit(0)), step, lambda acc: acc["out"])

    return let(spaced_tokens(text), cut)


def sentence_windows(text: Column, size: int = CHUNK_TOKENS, overlap: int = SENTENCE_OVERLAP) -> Column:
    """Whole sentences packed up to ``size`` tokens.

    A chunk starts with the closing sentences of the one before as far as they
    hold at most ``overlap`` tokens and still fit. A sentence longer than the
    bound is cut into plain windows first.
    """

    def bounded(sentence: Column) -> Column:
        return let(
            token_count(sentence),
            lambda n: F.when(
                n <= size, F.array(F.struct(sentence.alias("content"), n.cast("int").alias("n_tokens")))
            ).otherwise(counted_token_windows(sentence, size, 0)),
        )

    pieces = F.flatten(F.transform(sentences(text), bounded))

    def state(out: Column, cur: Column, n: Column) -> Column:
        return F.struct(out.alias("out"), cur.alias("cur"), n.cast("int").alias("n"))

    def joined(cur: Column) -> Column:
        return F.array_join(contents(cur), " ")

    def close(acc: Column) -> Column:
        return F.when(F.size(acc["cur"]) == 0, acc["out"]).otherwise(
            F.concat(acc["out"], F.array(joined(acc["cur"])))
        )

    none = F.array().cast(COUNTED)

    def tail(cur: Column, room: Column) -> Column:
        """Closing pieces of ``cur`` with at most ``overlap`` tokens, and at most ``room``."""
        start = F.struct(none.alias("kept"), F.lit(0).alias("n"), F.lit(False).alias("full"))

        def take(acc: Column, p: Column) -> Column:
            fits = ~acc["full"] & (acc["n"] + p["n_tokens"] <= F.least(F.lit(overlap), room))
            return F.struct(
                F.when(fits, F.concat(F.array(p), acc["kept"])).otherwise(acc["kept"]).alias("kept"),
                F.when(fits, acc["n"] + p["n_tokens"]).otherwise(acc["n"]).alias("n"),
                (~fits).alias("full"),
            )

        # Only the last ``overlap`` pieces can fit, as each holds a token.
        recent = F.slice(cur, -F.least(F.size(cur), F.lit(max(overlap, 1))), F.lit(max(overlap, 1)))
        return F.when(F.size(cur) == 0, start).otherwise(F.aggregate(F.reverse(recent), start, take))

    def step(acc: Column, p: Column) -> Column:
        return F.when(
            acc["n"] + p["n_tokens"] <= size,
            state(acc["out"], F.concat(acc["cur"], F.array(p)), acc["n"] + p["n_tokens"]),
        ).otherwise(
            let(
                tail(acc["cur"], F.lit(size) - p["n_tokens"]),
                lambda t: state(close(acc), F.concat(t["kept"], F.array(p)), t["n"] + p["n_tokens"]),
            )
        )

    return F.aggregate(pieces, state(F.array().cast("array<string>"), none, F.lit(0)), step, close)
