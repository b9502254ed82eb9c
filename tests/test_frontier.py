"""Fetching into a store: what is asked, what is kept, what a failed job leaves."""

import uuid

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import frontier


def server(calls, broken=()):
    """Keeps one file per call; hosts run in other processes."""

    def fetch(url):
        if url in broken:
            raise RuntimeError("server broke")
        (calls / uuid.uuid4().hex).write_text(url)
        return None if url.endswith("gone") else f"body of {url}"

    return fetch


def asked(calls):
    found = sorted(f.read_text() for f in calls.iterdir())
    for f in calls.iterdir():
        f.unlink()
    return found


@pytest.fixture
def calls(tmp_path):
    (tmp_path / "calls").mkdir()
    return tmp_path / "calls"


def urls_of(spark, urls):
    return spark.createDataFrame([(u, n) for n, u in enumerate(urls)], "url string, `n.o` int")


def test_only_missing_addresses_are_asked(spark, tmp_path, calls):
    store = str(tmp_path / "store")
    urls = ["https://a/1", "https://a/1", "https://b/2", "https://a/gone", None, ""]
    first = frontier.fetch_stored(urls_of(spark, urls), server(calls), store, workers=2, partitions=3)
    assert set(first.columns) == {"url", "n.o", "html"}
    got = {r["n.o"]: r["html"] for r in first.collect()}
    assert got == {0: "body of https://a/1", 1: "body of https://a/1", 2: "body of https://b/2", 3: None, 4: None, 5: "body of "}
    assert asked(calls) == ["", "https://a/1", "https://a/gone", "https://b/2"]
    # A rerun asks for what had no body, and more addresses for the new ones only.
    again = frontier.fetch_stored(urls_of(spark, [*urls, "https://c/3"]), server(calls), store, workers=2, partitions=3)
    assert asked(calls) == ["https://a/gone", "https://c/3"]
    assert {r["n.o"]: r["html"] for r in again.collect()} == got | {6: "body of https://c/3"}
    again.count()
    assert asked(calls) == []


def test_a_failed_wave_keeps_those_before(spark, tmp_path, calls):
    store, urls = str(tmp_path / "store"), [f"https://host{n % 3}/{n}" for n in range(60)]
    df = urls_of(spark, urls)
    keys = {r["url"]: r["w"] for r in df.select("url", F.pmod(F.xxhash64(F.md5("url")), F.lit(6)).alias("w")).collect()}
    broken = next(u for u in urls if keys[u] == 4)
    with pytest.raises(Exception, match="server broke"):
        frontier.fetch_missing(df, server(calls, {broken}), store, wave=10, workers=4, partitions=2)
    asked(calls)
    before = {u for u in urls if keys[u] < 4}
    assert {r["url"] for r in frontier.read_store(spark, store).collect()} == before
    assert frontier.fetch_missing(df, server(calls), store, wave=10, workers=4, partitions=2) == 60 - len(before)
    assert asked(calls) == sorted(set(urls) - before)
    assert frontier.read_store(spark, store).count() == 60


def test_one_host_stays_in_its_lanes(spark, tmp_path, calls):
    df = urls_of(spark, [f"https://hot/{n}" for n in range(40)] + ["https://other/1"])
    for lanes, most in ((1, 1), (3, 3)):
        dealt = df.repartition(8, frontier.host_of("url"), F.pmod(F.xxhash64("url"), F.lit(lanes)))
        tasks = {r[0] for r in dealt.filter("url like '%hot%'").select(F.spark_partition_id()).collect()}
        assert 1 <= len(tasks) <= most


def test_edges(spark, tmp_path, calls):
    store = str(tmp_path / "store")
    empty = urls_of(spark, ["https://a/1"]).filter("false")
    assert frontier.fetch_stored(empty, server(calls), store).count() == 0
    assert frontier.read_store(spark, store).count() == 0
    assert frontier.fetch_missing(urls_of(spark, [None]), server(calls), store) == 0
    with pytest.raises(ValueError, match="1 or more"):
        frontier.fetch_missing(empty, server(calls), store, wave=0)
