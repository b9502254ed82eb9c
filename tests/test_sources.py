import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.plans.parallelism import spread
from corpusloom.plans.workspace import fresh_path, materialize, shared_dir
from corpusloom.sources import files, tables, web

SITEMAP = """<?xml version="1.0" encoding="UTF-8"?>
<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">
<url><loc>https://x.example/a</loc></url><url><loc>https://x.example/b?q=1&amp;r=2</loc></url>
<url><loc>https://x.example/c</loc></url></urlset>"""


def test_sitemap(spark):
    xml = spark.createDataFrame([(SITEMAP,)], "xml string")
    urls = [r["url"] for r in web.sitemap_urls(xml).collect()]
    assert urls == ["https://x.example/a", "https://x.example/b?q=1&r=2", "https://x.example/c"]
    assert [r["url"] for r in web.sitemap_urls(xml, max_documents=2).collect()] == urls[:2]


def test_fetch_failures_become_null(spark):
    calls = {"https://ok": (200, "<p>"), "https://gone": (404, None)}

    def fetch(url):
        if url == "https://down":
            raise OSError("refused")
        return calls[url]

    urls = tables.from_items(spark, ["https://ok", "https://gone", "https://down"], "url")
    got = {r["url"]: r["html"] for r in web.fetch_pages(urls, web.with_retries(fetch), workers=2, partitions=2).collect()}
    assert got == {"https://ok": "<p>", "https://gone": None, "https://down": None}


def test_retries_on_too_many_requests():
    answers = [(429, None), (429, None), (200, "x")]
    fetch = web.with_retries(lambda url: answers.pop(0), backoff=0)
    assert fetch("u") == "x" and not answers
    tried = []
    give_up = web.with_retries(lambda url: tried.append(url) or (429, None), backoff=0)
    assert give_up("u") is None and len(tried) == 4


@pytest.mark.parametrize(
    "name,columns,rows",
    [
        ("customers", "first_name,last_name,address", ['Ann,Lee,"1 Main St, Town"', "Bob,,2 Side St"]),
        ("franchises", "country,city", ['"Korea, South",Seoul', "France,"]),
        ("reviews", "review,stars", ['"good, cheap",5', "bad,"]),
        ("cars", "Misspelled_Make,year", ['"Toyta, Inc",2001', "Hnda,"]),
        ("transactions", "id,note", ['1,"a,b"', "2,"]),
        ("travel", "destination_id,name", ['1,"Rome, Italy"', "2,"]),
        ("destinations", "destination_id,name", ['1,"Oslo, Norway"', "2,"]),
    ],
)
def test_csv(spark, tmp_path, name, columns, rows):
    path = tmp_path / f"{name}.csv"
    path.write_text("\n".join([columns, *rows]) + "\n")
    df = tables.load_csv(spark, str(path))
    first, second = df.collect()
    assert df.columns == columns.split(",")
    assert any("," in str(v) for v in first)
    assert None in tuple(second)
    stored = tables.overwrite_table(df, f"csv_{name}_{uuid.uuid4().hex}")
    assert stored.count() == 2


def test_ensure_table_builds_once(spark):
    name, built = f"t_{uuid.uuid4().hex}", []

    def build():
        built.append(1)
        return spark.range(3)

    assert tables.ensure_table(spark, name, build).count() == 3
    assert tables.ensure_table(spark, name, build).count() == 3
    assert len(built) == 1
    tables.overwrite_table(spark.range(0), name)
    assert tables.ensure_table(spark, name, build).count() == 3
    with pytest.raises(ValueError):
        tables.ensure_table(spark, "x; drop", build)


def test_namespaces(spark):
    schema = f"s_{uuid.uuid4().hex}"
    try:
        tables.use_schema(spark, schema)
        assert tables.current_namespace(spark).head()["schema"] == schema
        assert "spark_catalog" in [r[0] for r in tables.list_catalogs(spark).collect()]
        spark.range(1).write.saveAsTable("t")
        with pytest.raises(Exception):
            tables.drop_schema(spark, schema)
    finally:
        spark.sql("USE default")
        tables.drop_schema(spark, schema, cascade=True)
    assert schema not in [d.name for d in spark.catalog.listDatabases()]


def test_frames_and_names(spark):
    assert tables.from_frame(spark, pd.DataFrame({"a": [1, 2]})).count() == 2
    mail = spark.createDataFrame([("ann.o-neil@x.org",)], "m string")
    assert mail.select(tables.user_slug(F.col("m"))).head()[0] == "annoneil"
    urls = spark.createDataFrame([("h://x/NOTICE.txt",), ("h://x/a.pdf",)], "url string")
    assert [r["file_name"] for r in web.keep_sources(urls, "url").collect()] == ["a.pdf"]


def test_split_and_sample_depend_on_the_key_only(spark):
    ids = spark.range(2000)
    first = {r["id"]: r["split"] for r in tables.hash_split(ids, "id", {"a": 3, "b": 1}).collect()}
    again = {r["id"]: r["split"] for r in tables.hash_split(ids.repartition(7).orderBy(F.desc("id")), "id", {"a": 3, "b": 1}).collect()}
    assert first == again
    assert 0.7 < sum(v == "a" for v in first.values()) / 2000 < 0.8
    sample = tables.hash_sample(ids, "id", 0.1, seed=2)
    assert 150 < sample.count() < 250
    capped = [r["id"] for r in tables.hash_sample(ids.repartition(5), "id", 0.1, seed=2, cap=10).collect()]
    assert len(capped) == 10 and capped == [r["id"] for r in tables.hash_sample(ids, "id", 0.1, seed=2, cap=10).collect()]


def test_chunk_ids_are_stable(spark):
    rows = [("u", 0, "a"), ("u", 1, "a"), ("v", 0, "a")]
    df = spark.createDataFrame(rows, "url string, pos int, content string")
    ids = {r["id"] for r in tables.with_chunk_id(df).collect()}
    assert len(ids) == 3
    assert ids == {r["id"] for r in tables.with_chunk_id(df.repartition(3)).collect()}


def test_binary_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("Größe".encode())
    (tmp_path / "b.bin").write_bytes(b"\xff")
    read = files.read_files(spark, str(tmp_path), "*.txt")
    assert files.decode_text(read).head()["text"] == "Größe"

    def parser(body):
        if body == b"\xff":
            raise ValueError("unreadable")
        return body.decode()[:2]

    both = files.decode_text(files.read_files(spark, str(tmp_path)), parser)
    assert {r["text"] for r in both.collect()} == {"Gr", None}


def test_shared_folder(spark):
    assert fresh_path(spark, "x").startswith(shared_dir(spark))
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    df = materialize(spark.range(5).withColumn("r", F.rand()), "rand")
    assert df.collect() == df.collect()
    assert "FileScan" in df._jdf.queryExecution().executedPlan().toString()


def test_spread_leaves_large_scans_alone(spark, sf):
    scan = spark.read.parquet(f"{sf}/documents.parquet")
    assert spread(scan, 4).rdd.getNumPartitions() == 4
    assert spread(scan, 1) is scan
