"""Sources, joins, aggregates and latest-per-key picks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom.functions.registry import SqlFunction, register_functions
from corpusloom.operators import feedback, relational as rel
from corpusloom.operators.structured import json_number
from corpusloom.plans.workspace import fresh_path
from corpusloom.sources import frontier, tables, web
from corpusloom.suite import Suite, table

suite = Suite()


def _micros(column: str):
    """Microseconds since 1970 of a time without zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {column})")


@suite.add("""
SELECT n_name AS name, count(o_orderkey) AS purchases
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name ORDER BY purchases DESC, name LIMIT 10
""")
def top_locations(spark, sf):
    customer = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    dim = customer.select(F.col("c_custkey").alias("o_custkey"), "n_name")
    return rel.top_groups(table(spark, sf, "orders"), dim, "o_custkey", "n_name", "o_orderkey", 10)


BUSIEST_NATIONS = SqlFunction(
    name="busiest_nations",
    args="",
    returns="TABLE(nation STRING, orders INT)",
    comment="Ten locations with the most purchases.",
    body=(
        "SELECT n.n_name AS location, cast(count(o.o_orderkey) AS INT) AS total "
        "FROM orders_t o JOIN customer_t c ON o.o_custkey = c.c_custkey "
        "JOIN nation_t n ON c.c_nationkey = n.n_nationkey "
        "GROUP BY n.n_name ORDER BY count(o.o_orderkey) DESC, n.n_name LIMIT 10"
    ),
)


@suite.add("""
SELECT n_name AS nation, CAST(count(o_orderkey) AS INT) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name ORDER BY orders DESC, nation LIMIT 10
""")
def table_function(spark, sf):
    for name in ("orders", "customer", "nation"):
        table(spark, sf, name).createOrReplaceTempView(f"{name}_t")
    register_functions(spark, [BUSIEST_NATIONS])
    return spark.sql("SELECT * FROM busiest_nations()")


CORRECTION_PROMPT = SqlFunction(
    name="correction_prompt",
    args="text STRING",
    returns="STRING",
    comment="Prompt asking for the corrected spelling of a name.",
    body="concat(format_string('Correct the spelling of this name: %s', ''), text)",
)


@suite.add("""
SELECT s_suppkey, concat('Correct the spelling of this name: ', s_name) AS prompt FROM supplier
""")
def scalar_function(spark, sf):
    register_functions(spark, [CORRECTION_PROMPT])
    return table(spark, sf, "supplier").selectExpr("s_suppkey", "correction_prompt(s_name) AS prompt")


@suite.add("""
SELECT page_id, url AS doc_uri, CAST(length(url) AS INT) AS url_length FROM pages WHERE url IS NOT NULL
""")
def snapshot_columns(spark, sf):
    return (
        tables.load_snapshot(spark, f"{sf}/pages.parquet", drop=["html"])
        .withColumnRenamed("url", "doc_uri")
        .filter("doc_uri is not null")
        .withColumn("url_length", F.length("doc_uri"))
    )


@suite.add("SELECT doc_id, lang, source, n_chars FROM documents")
def select_except(spark, sf):
    table(spark, sf, "documents").createOrReplaceTempView("documents_t")
    return spark.sql("SELECT * EXCEPT (text) FROM documents_t")


@suite.add("""
SELECT event_id, props->>'$.k' AS raw, TRY_CAST(props->>'$.k' AS BIGINT) AS k,
       TRY_CAST(props->>'$.k' AS BIGINT) < 50 AS valid
FROM events
""")
def lateral_alias(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id", "get_json_object(props, '$.k') AS raw", "try_cast(raw AS BIGINT) AS k", "k < 50 AS valid"
    )


@suite.add("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def csv_round_trip(spark, sf):
    customer = table(spark, sf, "customer")
    path = fresh_path(spark, "csv")
    customer.write.option("header", True).option("escape", '"').csv(path)
    return tables.load_csv(spark, path, customer.schema)


@suite.add("""
SELECT 'built' AS step, count(*) AS rows, CAST(sum(s_suppkey) AS BIGINT) AS keys FROM supplier
UNION ALL SELECT 'kept', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier
""")
def ensured_table(spark, sf):
    """A missing table is built; one that is there is kept, whatever a second builder would give."""
    name, supplier = f"ensured_{uuid.uuid4().hex}", table(spark, sf, "supplier")
    path, out = fresh_path(spark, "ensured"), None
    for step, build in (("built", lambda: supplier), ("kept", lambda: supplier.filter("false"))):
        tables.ensure_table(spark, name, build, path=path)
        part = spark.table(name).agg(F.count(F.lit(1)).alias("rows"), F.sum("s_suppkey").cast("long").alias("keys"))
        out = part.select(F.lit(step).alias("step"), "*") if out is None else out.unionByName(part.select(F.lit(step).alias("step"), "*"))
    return out


@suite.add("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def overwrite_sink(spark, sf):
    """Build a managed table when it is missing, then replace and read it."""
    name = f"suppliers_{uuid.uuid4().hex}"
    path = fresh_path(spark, "table")
    supplier = table(spark, sf, "supplier")
    tables.ensure_table(spark, name, lambda: supplier, path=path)
    return tables.overwrite_table(supplier, name, path=f"{path}-new")


@suite.add("""
SELECT url FROM pages
""")
def sitemap_addresses(spark, sf):
    escaped = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    xml = F.concat(
        F.lit('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>'),
        escaped,
        F.lit("</loc></url></urlset>"),
    )
    return web.sitemap_urls(table(spark, sf, "pages").select(xml.alias("xml")))


# Fixed value: addresses that one sitemap document may hold.
SITEMAP_URLS = 50_000


@suite.add("""
SELECT url FROM (SELECT url, dense_rank() OVER (ORDER BY regexp_extract(url, '//([^/]*)', 1)) AS doc, page_id FROM pages)
ORDER BY doc, page_id LIMIT 30
""")
def sitemap_cap(spark, sf):
    """Sitemaps of bounded length with all addresses of a host; the first thirty by host and place are kept."""
    escaped = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    locations = F.transform(
        F.sort_array(F.collect_list(F.struct("page_id", escaped.alias("url")))),
        lambda p: F.concat(F.lit("<url><loc>"), p["url"], F.lit("</loc></url>")),
    )
    # Ids are unique, so a range of them holds at most as many addresses; ranges keep the order of a host's pages.
    part = F.floor(F.col("page_id") / SITEMAP_URLS)
    place = F.struct(F.regexp_extract("url", "//([^/]*)", 1).alias("host"), part.alias("part"))
    maps = table(spark, sf, "pages").groupBy(place.alias("place")).agg(locations.alias("l"))
    xml = F.concat(F.lit("<urlset>"), F.array_join("l", ""), F.lit("</urlset>"))
    return web.sitemap_urls(maps.select("place", xml.alias("xml")), max_documents=30, order="place")


@suite.add("""
SELECT url, CAST(length(html) AS INT) AS n_chars, md5(html) AS digest FROM pages
""")
def fetch_offline(spark, sf):
    """Every page address and as many unknown ones; unknown addresses give null and are filtered."""
    pages = table(spark, sf, "pages")
    urls = pages.select("url").unionByName(pages.select(F.concat("url", F.lit("/missing")).alias("url")))
    fetched = web.join_pages(urls, pages).filter("html is not null")
    return fetched.select("url", F.length("html").alias("n_chars"), F.md5("html").alias("digest"))


def page_server(url: str) -> str | None:
    """Stand-in server: a page that names its address, nothing for every fifth length of an address."""
    return None if len(url) % 5 == 0 else f"<p>{url}</p>"


@suite.add("""
WITH u AS (SELECT page_id, url FROM pages UNION ALL SELECT -page_id - 1, url || '?print' FROM pages WHERE page_id % 3 = 0)
SELECT page_id, CASE WHEN length(url) % 5 > 0 THEN md5('<p>' || url || '</p>') END AS digest,
       (SELECT count(DISTINCT url) FROM u WHERE length(url) % 5 = 0) AS asked_again
FROM u
""")
def fetched_pages(spark, sf):
    """Pages fetched into a store, then pages and print versions: only new and failed addresses are asked, then failed ones."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    printed = pages.filter("page_id % 3 = 0").select((-F.col("page_id") - 1).alias("page_id"), F.concat("url", F.lit("?print")).alias("url"))
    every, store = pages.unionByName(printed), fresh_path(spark, "fetched")
    frontier.fetch_missing(pages, page_server, store, partitions=8)
    fetched = frontier.fetch_stored(every, page_server, store, partitions=8)
    again = frontier.missing_urls(every, store).count()
    return fetched.select("page_id", F.md5("html").alias("digest"), F.lit(again).cast("bigint").alias("asked_again"))


@suite.add("""
SELECT page_id, string_split(url, '/')[-1] AS file_name, replace(url, 'http://', 'https://') AS address
FROM pages WHERE NOT contains(string_split(url, '/')[-1], 'ref')
""")
def source_names(spark, sf):
    kept = web.keep_sources(table(spark, sf, "pages"), "url", without="ref")
    return kept.select(
        "page_id", "file_name", web.rewrite_prefix(F.col("url"), "http://", "https://").alias("address")
    )


@suite.add("""
SELECT doc_id, CASE WHEN b < 800 THEN 'train' ELSE 'validation' END AS split
FROM (SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 1000 AS b FROM documents)
""")
def train_validation_split(spark, sf):
    return tables.hash_split(table(spark, sf, "documents").select("doc_id"), "doc_id", {"train": 800, "validation": 200})


@suite.add("""
SELECT doc_id, n_chars
FROM documents
WHERE ('0x' || substr(md5('2:' || doc_id::VARCHAR), 1, 8))::BIGINT % 1000000 < 100000
ORDER BY md5('2:' || doc_id::VARCHAR), doc_id LIMIT 10
""")
def seeded_sample(spark, sf):
    """A sampling operator: a tenth of the rows by hash, then the first ten in hash order."""
    return tables.hash_sample(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id", 0.1, seed=2, cap=10)


@suite.add("""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def ordered_limit(spark, sf):
    return (
        table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
    )


@suite.add("SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def event_type_counts(spark, sf):
    return rel.value_counts(table(spark, sf, "events"), "event_type")


def _labelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id").select(
        F.col("quality").alias("truth"),
        # Short texts get no reply, long ones one outside the classes.
        F.when(F.col("n_chars") < 200, None).when(F.col("n_chars") > 8000, 7).otherwise((F.col("n_chars") >= 500).cast("int")).alias("pred"),
    )


@suite.add("""
SELECT quality AS truth, count_if(n_chars BETWEEN 200 AND 499) AS "0", count_if(n_chars BETWEEN 500 AND 8000) AS "1",
       count_if(NOT n_chars BETWEEN 200 AND 8000) AS other
FROM documents JOIN labels USING (doc_id) GROUP BY quality
""")
def label_confusion(spark, sf):
    return rel.confusion_matrix(_labelled(spark, sf), "truth", "pred", [0, 1])


@suite.add("""
WITH r AS (SELECT quality AS t, CASE WHEN n_chars > 8000 THEN 7 WHEN n_chars >= 200 THEN CAST(n_chars >= 500 AS INT) END AS p
           FROM documents JOIN labels USING (doc_id)),
c AS (SELECT DISTINCT t AS class FROM r UNION SELECT DISTINCT p FROM r WHERE p IS NOT NULL)
SELECT class,
       CAST((SELECT count(*) FROM r WHERE t = class) AS BIGINT) AS support,
       round((SELECT count(*) FILTER (t = p) / nullif(count(*), 0) FROM r WHERE p = class), 6) AS precision,
       round((SELECT count(*) FILTER (coalesce(t = p, false)) / nullif(count(*), 0) FROM r WHERE t = class), 6) AS recall,
       round((SELECT avg(CAST(coalesce(t = p, false) AS INT)) FROM r), 6) AS accuracy
FROM c
""")
def label_scores(spark, sf):
    report = rel.classification_report(_labelled(spark, sf), "truth", "pred")
    return report.select("class", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "accuracy")])


@suite.add("SELECT p_brand, max(TRY_CAST(p_size AS INT)) AS latest_version FROM part GROUP BY p_brand")
def latest_versions(spark, sf):
    part = table(spark, sf, "part").select("p_brand", F.col("p_size").cast("string").alias("version"))
    return rel.latest_version(part, "p_brand", "version", default=1)


@suite.add("""
SELECT user_id, count(*) AS replies,
       round(avg(CAST(event_type IN ('click', 'view', 'purchase') AS INT)), 6) AS compliance
FROM events GROUP BY user_id
""")
def reply_compliance(spark, sf):
    rate = rel.compliance_rate(table(spark, sf, "events"), "event_type", ["click", "view", "purchase"], ["user_id"])
    return rate.withColumn("compliance", F.round("compliance", 6))


@suite.add("""
SELECT user_id, event_type, votes FROM (
  SELECT user_id, event_type, count(*) AS votes,
         row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r
  FROM events WHERE event_type IS NOT NULL GROUP BY user_id, event_type) WHERE r = 1
""")
def majority_event(spark, sf):
    return rel.majority_vote(table(spark, sf, "events"), "user_id", "event_type")


@suite.add("""
SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
""")
def latest_event_per_user(spark, sf):
    latest = rel.latest_per_key(table(spark, sf, "events"), ["user_id"], ["ts"], ["event_id"])
    return latest.select("event_id", _micros("ts").alias("ts_us"), "user_id", "event_type", "value", "props")


@suite.add("""
SELECT c_custkey, n.n_regionkey, r_name
FROM customer JOIN nation n ON c_nationkey = n.n_nationkey
LEFT JOIN (SELECT lower(n_name) AS k, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) d
  ON lower(upper(n.n_name)) = d.k
""")
def lookup_attributes(spark, sf):
    nation = table(spark, sf, "nation")
    keyed = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    keyed = keyed.select("c_custkey", "n_regionkey", F.upper("n_name").alias("name_key"))
    region = table(spark, sf, "region")
    dim = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
    return rel.lookup_enrich(keyed, "name_key", dim, "n_name").select("c_custkey", "n_regionkey", "r_name")


@suite.add("""
SELECT p_partkey, p_name AS name, p_size AS height, CAST(p_partkey AS INT) AS weight,
       array_to_string(string_split(p_type, ' '), '|') AS abilities, p_brand AS types,
       'size|brand_length' AS stat_names, concat(p_size, '|', length(p_brand)) AS stat_values
FROM part
""")
def lookup_payload(spark, sf):
    """Parts looked up by name in a table of JSON payloads, nested lists flattened."""
    part = table(spark, sf, "part")
    named = F.transform(
        F.split("p_type", " "), lambda a: F.struct(F.struct(a.alias("name")).alias("ability"))
    )

    def stat(name, value):
        return F.struct(F.struct(F.lit(name).alias("name")).alias("stat"), value.alias("base_stat"))

    payload = F.to_json(
        F.struct(
            F.col("p_name").alias("name"),
            F.col("p_size").alias("height"),
            F.col("p_partkey").alias("weight"),
            named.alias("abilities"),
            F.array(F.struct(F.struct(F.col("p_brand").alias("name")).alias("type"))).alias("types"),
            F.array(stat("size", F.col("p_size")), stat("brand_length", F.length("p_brand"))).alias("stats"),
        )
    )
    # Names are not unique, the part key makes them so.
    key = F.concat_ws(" ", "p_name", "p_partkey")
    dim = part.select(F.lower(key).alias("item"), payload.alias("payload_json"))
    found = rel.lookup_enrich(
        part.select("p_partkey", F.upper(key).alias("asked")), "asked", dim, "item", "payload_json", rel.PAYLOAD_DDL
    )
    flat = found.select("p_partkey", *rel.flatten_payload(F.col("payload")))
    lists = ("abilities", "types", "stat_names", "stat_values")
    joined = [F.array_join(F.col(c).cast("array<string>"), "|").alias(c) for c in lists]
    return flat.select("p_partkey", "name", "height", "weight", *joined)


@suite.add("""
WITH w AS (SELECT c_custkey, concat(substr(n_name, 1, 2), substr(n_name, 4)) AS misspelled
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
d AS (SELECT m.misspelled, n_name, levenshtein(lower(m.misspelled), lower(n_name)) AS distance
      FROM (SELECT DISTINCT misspelled FROM w) m, nation)
SELECT c_custkey, misspelled, nearest, distance FROM w LEFT JOIN (
  SELECT misspelled, n_name AS nearest, CAST(distance AS INT) AS distance,
         row_number() OVER (PARTITION BY misspelled ORDER BY distance, n_name) AS r
  FROM d WHERE distance <= 2) b USING (misspelled)
WHERE r = 1 OR r IS NULL
""")
def corrected_names(spark, sf):
    nation = table(spark, sf, "nation")
    customer = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    misspelled = F.concat(F.substr("n_name", F.lit(1), F.lit(2)), F.substr("n_name", F.lit(4)))
    rows = customer.select("c_custkey", misspelled.alias("misspelled"))
    terms = nation.select(F.col("n_name").alias("term"))
    return rel.nearest_term(rows, "misspelled", terms).select("c_custkey", "misspelled", "nearest", "distance")


def _assessments(spark, sf):
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("request_id"),
        (F.col("event_id") % 2).alias("step_id"),
        F.struct((F.col("event_id") % 3).alias("id")).alias("source"),
        F.col("ts").alias("timestamp"),
        F.when(kind.isin("click", "view"), kind).alias("text_assessment"),
        F.when(kind.isin("purchase", "error"), kind).alias("retrieval_assessment"),
        F.lit("v1").alias("schema_version"),
    )


def _flat_assessments(df):
    return df.select(
        "request_id",
        F.col("source.id").alias("reviewer"),
        _micros("timestamp").alias("ts_us"),
        "text_assessment",
        "schema_version",
        F.array_join("retrieval_assessments", "|").alias("retrievals"),
    )


_ASSESSMENTS = """
WITH a AS (SELECT user_id AS request_id, event_id % 2 AS step_id, event_id % 3 AS reviewer, ts,
                  CASE WHEN event_type IN ('click', 'view') THEN event_type END AS t,
                  CASE WHEN event_type IN ('purchase', 'error') THEN event_type END AS r FROM events)
"""


@suite.add(_ASSESSMENTS + """
, x AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts DESC) AS n
                       FROM a WHERE t IS NOT NULL) WHERE n = 1),
y AS (SELECT request_id, reviewer, step_id, string_agg(r, '|' ORDER BY r) AS retrievals
      FROM a WHERE r IS NOT NULL GROUP BY request_id, reviewer, step_id)
SELECT x.request_id, x.reviewer, epoch_us(x.ts) AS ts_us, x.t AS text_assessment,
       CASE WHEN x.request_id IS NOT NULL THEN 'v1' END AS schema_version, y.retrievals
FROM x FULL JOIN y ON x.request_id = y.request_id AND x.reviewer = y.reviewer
""")
def assessments_compat(spark, sf):
    return _flat_assessments(feedback.deduplicate_assessments(_assessments(spark, sf), "compat"))


@suite.add(_ASSESSMENTS + """
, x AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id, reviewer ORDER BY ts DESC) AS n
                       FROM a WHERE t IS NOT NULL) WHERE n = 1),
y AS (SELECT request_id, reviewer, string_agg(r, '|' ORDER BY r) AS retrievals
      FROM a WHERE r IS NOT NULL GROUP BY request_id, reviewer)
SELECT coalesce(x.request_id, y.request_id) AS request_id, coalesce(x.reviewer, y.reviewer) AS reviewer,
       epoch_us(x.ts) AS ts_us, x.t AS text_assessment,
       CASE WHEN x.request_id IS NOT NULL THEN 'v1' END AS schema_version, y.retrievals
FROM x FULL JOIN y ON x.request_id = y.request_id AND x.reviewer = y.reviewer
""")
def assessments_fixed(spark, sf):
    return _flat_assessments(feedback.deduplicate_assessments(_assessments(spark, sf), "fixed"))


@suite.add("""
SELECT c_custkey, format('{}-{}', lower(c_mktsegment), upper(c_name)) AS slug,
       CAST(length(replace(c_name, '#', '')) AS INT) AS n,
       translate(lower(c_name), '#0', '') AS user_slug,
       TRY_CAST(c_name AS BIGINT) AS no_number,
       array_to_string(list_slice(string_split(c_name, ''), 1, 4), '-') AS head
FROM customer
""")
def scalar_functions(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.format_string("%s-%s", F.lower("c_mktsegment"), F.upper("c_name")).alias("slug"),
        F.length(F.replace(F.col("c_name"), F.lit("#"), F.lit(""))).alias("n"),
        F.translate(F.lower("c_name"), "#0", "").alias("user_slug"),
        F.col("c_name").try_cast("bigint").alias("no_number"),
        F.array_join(F.slice(F.split("c_name", ""), 1, 4), "-").alias("head"),
    )


@suite.add("""
SELECT event_id, TRY_CAST(props->>'$.k' AS BIGINT) AS k, concat('tags:', event_type, '|', user_id) AS tags FROM events
""")
def literal_arrays(spark, sf):
    tags = F.array_join(F.array(F.concat(F.lit("tags:"), "event_type"), F.col("user_id").cast("string")), "|")
    return table(spark, sf, "events").select("event_id", json_number(F.col("props"), "$.k").alias("k"), tags.alias("tags"))
