"""Registered queries of the training-data operators; digests are derived here from the operators' results."""

from __future__ import annotations

import pyspark.sql.functions as F

from corpusloom.llm import (
    decontamination,
    mixing,
    neighbours,
    prefix_trie,
    repair,
    repetition,
    secrets,
    sharding,
    simhash,
    substrings,
    templates,
    token_counts,
    toxicity,
)
from corpusloom.plans.workspace import fresh_path
from corpusloom.suite import Suite, table

suite = Suite()

WORD = r"[^\x20\x09-\x0D]+"

# Windows are told apart by their words, which hold no space.
SUBSTRINGS_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS ws FROM documents),
g AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d),
k AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS w FROM g),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY w) AS n FROM k) WHERE n > 1),
p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
c AS (SELECT p.*, coalesce(max(r.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS UNBOUNDED PRECEDING) + 34 >= p.i, false) AS gone
      FROM p LEFT JOIN r USING (doc_id, i)),
s AS (SELECT doc_id, count_if(gone)::BIGINT AS n, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""

# Words in repeated windows of a document; repeats of 8 words or more cover what repeated 8-word windows do.
REPEATS_SQL = """
g{n} AS (SELECT doc_id, i, array_to_string(ws[i:i + {n} - 1], ' ') AS w FROM (
  SELECT doc_id, ws, unnest(range(1, len(ws) - {n} + 2)) AS i FROM d)),
r{n} AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM g{n}) WHERE n > 1),
c{n} AS (SELECT doc_id, count(DISTINCT j)::BIGINT AS c{n} FROM (SELECT doc_id, unnest(range(i, i + {n})) AS j FROM r{n}) GROUP BY 1)"""

QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '{WORD}'), []) AS ws FROM documents),
{REPEATS_SQL.format(n=3)}, {REPEATS_SQL.format(n=8)}, {REPEATS_SQL.format(n=101)},
l AS (SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{WORD}') GROUP BY 1),
q AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
        coalesce(c3, 0)::BIGINT AS n_repeat_words, coalesce(c8, 0)::BIGINT AS covered_words, c101 IS NOT NULL AS long
      FROM d LEFT JOIN l USING (doc_id) LEFT JOIN c3 USING (doc_id) LEFT JOIN c8 USING (doc_id) LEFT JOIN c101 USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, covered_words,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND covered_words <= 0.4 * n_words AND NOT long AS kept
FROM q
"""

# The pages of the table have one article each, built of h1, p, b and br, and four named character references.
PAGES_SQL = r"""
WITH a AS (SELECT page_id, url, unnest(string_split_regex(
    regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1), '</?(p|h1)>')) AS part,
    unnest(range(len(string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1), '</?(p|h1)>')))) AS i
  FROM pages),
t AS (SELECT page_id, i, trim(regexp_replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(part, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
    '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g')) AS block FROM a),
j AS (SELECT page_id, string_agg(block, chr(10) || chr(10) ORDER BY i) AS text FROM t WHERE block <> '' GROUP BY 1)
SELECT page_id, url, coalesce(j.text, '') AS text, length(coalesce(j.text, ''))::BIGINT AS n_chars
FROM pages LEFT JOIN j USING (page_id)
"""

# CRC-32 of an ASCII string, bit by bit.
CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::UBIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::UBIGINT[]),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)), 4294967295::UBIGINT)::BIGINT"""

# Prefixes as strings of turn digests; every node adds to all nodes above it.
TRIE_SQL = rf"""
WITH t AS (SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS w, turn FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list(m ORDER BY turn NULLS FIRST, m) AS ms, list(w ORDER BY turn NULLS FIRST, m) AS ws FROM t GROUP BY 1),
h AS (SELECT *, {CRC32_SQL.format("conv_id::VARCHAR")} % 4 AS h FROM l),
r AS (SELECT c.conv_id, list_concat(coalesce(a.ms[1:c.h], []), c.ms[c.h + 1:]) AS ms, list_concat(coalesce(a.ws[1:c.h], []), c.ws[c.h + 1:]) AS ws
      FROM h c LEFT JOIN l a ON a.conv_id = c.conv_id - c.conv_id % 20),
p AS (SELECT conv_id, d, array_to_string(ms[1:d], ' ') AS k, CASE WHEN d > 0 THEN array_to_string(ms[1:d - 1], ' ') END AS up,
        CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w, d = len(ms) AS ends
      FROM (SELECT *, unnest(range(0, len(ms) + 1)) AS d FROM r)),
n AS (SELECT k, d AS depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS own,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
      FROM p GROUP BY 1, 2),
c AS (SELECT up AS k, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY 1),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf FROM n LEFT JOIN c USING (k)),
s AS (SELECT array_to_string(string_split(k, ' ')[1:i], ' ') AS k, sum(leaf)::BIGINT AS n_leaves, sum(own)::BIGINT AS saved_tokens
      FROM (SELECT *, unnest(range(0, depth + 1)) AS i FROM v) GROUP BY 1)
SELECT v.conv_id, v.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM v JOIN s USING (k) LEFT JOIN n q ON q.k = v.up
"""


def _repair_sql() -> str:
    """Cheapest edits from the last row of each conversation to its first: (cost, audit, rest of the repaired text) per state."""
    step = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    roles = {"u": "user", "a": "assistant"}

    def way(letter: str, cost: str, rest: str, line: str = "") -> str:
        text = f"chr(10) || {line} || {rest}.t" if line else f"{rest}.t"
        return f"struct_pack(c := {rest}.c + {cost}, a := '{letter}' || {rest}.a, t := {text})"

    def edits(state: int) -> str:
        kept = "".join(f" WHEN '{x}' THEN {way('K', 'more', f'b{s}', 'line')}" for x, s in step[state].items())
        fit = "a" if state == 2 else "u"
        renamed = way("R", "3 + more", f"b{step[state][fit]}", f"'{roles[fit]}:' || text")
        ways = f"[CASE left(role, 1){kept} END, {renamed}]"
        return f"list_min(list_prepend({way('D', '4', f'b{state}')}, CASE WHEN fault IN (1, 2) THEN [] ELSE {ways} END))"

    def inserted(state: int, rests: str) -> str:
        fit = "a" if state == 2 else "u"
        added = way("I", "3", f"{rests}{step[state][fit]}", f"'{roles[fit]}:'")
        return f"list_min([{rests}{state}, {added}]) AS {{}}{state}"

    def layer(before: str, after: str) -> str:
        return ", ".join(inserted(s, before).format(after) for s in range(4))

    first = ", ".join(f"struct_pack(c := {0 if s in (0, 3) else 1000000000}::BIGINT, a := '', t := '') AS x{s}" for s in range(4))
    return rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {CRC32_SQL.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind FROM conversations),
m AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS i FROM m),
f AS (SELECT *, role || ':' || text AS line, lead(role) OVER w AS after,
    CASE WHEN NOT regexp_matches(text, '{WORD}') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
         WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 3 ELSE 0 END AS fault
  FROM o WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
n AS (SELECT conv_id, max(i) AS i, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 1)::BIGINT AS blank,
    count_if(fault = 2)::BIGINT AS duplicate, count_if(fault = 3)::BIGINT AS truncated,
    count_if(after IS NOT NULL AND left(role, 1) || left(after, 1) NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal FROM f GROUP BY 1),
z AS (SELECT {first}),
z1 AS (SELECT {layer("x", "y")} FROM z), z2 AS (SELECT {layer("y", "x")} FROM z1), z3 AS (SELECT {layer("x", "b")} FROM z2),
s AS (
  SELECT conv_id, i, b0, b1, b2, b3 FROM n, z3
  UNION ALL
  SELECT conv_id, i, {layer("v", "b").replace(" AS b", " AS c")} FROM (
    SELECT conv_id, i, {layer("u", "v")} FROM (
      SELECT conv_id, i, {layer("x", "u")} FROM (
        SELECT conv_id, i - 1 AS i, {", ".join(f"{edits(e)} AS x{e}" for e in range(4))}
        FROM (SELECT s.*, f.role, f.text, f.line, f.fault, CASE f.fault WHEN 3 THEN 3 ELSE 0 END AS more FROM s JOIN f USING (conv_id, i)))))
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b0.c, 0) AS cost, coalesce(b0.a, '') AS audit, sha256(coalesce(b0.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n USING (conv_id) LEFT JOIN s ON s.conv_id = c.conv_id AND s.i = 0
"""


REPAIR_SQL = _repair_sql()

# Score from which a text counts as toxic.
TOXIC_FROM = 0.3


@suite.add()
def op4_toxicity(spark, sf):
    """Toxicity score of every document, from a model fitted outside the held-out quarter."""
    docs = table(spark, sf, "documents")
    training = toxicity.Training()
    sample = toxicity.training_rows(docs, table(spark, sf, "labels"), "doc_id", "text", "toxic", training.sample_rows)
    scores = toxicity.score_texts(docs, toxicity.fit(sample, training))
    return scores.select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


@suite.add()
def op7_secrets(spark, sf):
    """Counts and digest of the base spans and all spans of every document."""
    spans = secrets.scan_spans(table(spark, sf, "documents"))

    def joined(items):
        return F.array_join(
            F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return spans.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        count("random"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@suite.add(QUALITY_SQL)
def op8_repetition(spark, sf):
    """Quality counts, repeat measures and verdict of every document."""
    return repetition.quality_rules(table(spark, sf, "documents")).drop("longest_repeat")


@suite.add()
def op9_token_counts(spark, sf):
    """Token count of every document, found again in flat token files written from the table."""
    path = fresh_path(spark, "token-files")
    token_counts.write_token_files(table(spark, sf, "documents"), path)
    counts = token_counts.count_tokens(token_counts.read_token_blocks(spark, path))
    ids = token_counts.read_document_ids(spark, path)
    return ids.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")


@suite.add()
def op10_decontamination(spark, sf):
    """Every benchmark item that a document contains, with its edit distance and place."""
    return decontamination.find_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@suite.add()
def op1_sharding(spark, sf):
    """All documents in 16 shards of equal counts, equal texts together where quotas allow."""
    return sharding.shard_documents(table(spark, sf, "documents"))


@suite.add()
def op2_mixing(spark, sf):
    """Words that the mix takes of every document: those of its blocks, in all and in each output shard, and their order there."""
    blocks = mixing.mix_documents(table(spark, sf, "documents"))
    there = [F.coalesce(F.sum(F.when(F.col("shard") == i, F.col("words"))), F.lit(0)) for i in range(mixing.SHARDS)]
    drawn = F.when(F.col("shard").isNotNull(), F.xxhash64("shard", "order", "block", "pass", "words"))
    rows = blocks.groupBy("doc_id", "place", "copy", "size", "source_size", "target").agg(
        F.array(*there).alias("shard_words"), F.coalesce(F.bit_xor(drawn), F.lit(0)).alias("order_digest")
    )
    # The mix of a document is what its blocks bring to the shards.
    taken = F.aggregate("shard_words", F.lit(0).cast("long"), lambda a, b: a + b).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken, "shard_words", "order_digest")


@suite.add()
def op6_simhash(spark, sf):
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@suite.add(SUBSTRINGS_SQL)
def op3_substrings(spark, sf):
    """Words of every document in repeated windows, and the digest of the others."""
    kept = substrings.remove_repeats(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@suite.add(PAGES_SQL)
def op5_main_text(spark, sf):
    """Main text of every page."""
    return templates.main_text(table(spark, sf, "pages"))


@suite.add(TRIE_SQL)
def op11_prefix_trie(spark, sf):
    """Every node of the trie of rebuilt conversations, with members, children, leaves and saved tokens."""
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))


@suite.add(REPAIR_SQL)
def op12_repair(spark, sf):
    """Faults and cheapest repair of every damaged conversation."""
    return repair.repair(table(spark, sf, "conversations"))


@suite.add()
def op13_neighbours(spark, sf):
    """The ten nearest vectors of every hundredth."""
    return neighbours.nearest(table(spark, sf, "embeddings"), is_query=F.col("vec_id") % 100 == 0, k=10)
