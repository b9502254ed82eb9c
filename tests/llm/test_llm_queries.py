"""Registered queries of the subpackage over the small tables, against their SQL where they have one."""

import hashlib
import json
import re
import zlib
from pathlib import Path

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from corpusloom.llm.suite import suite
from tools.check import rows_of


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(suite.oracles))
def test_oracle(spark, con, name):
    df = suite.queries[name](spark, SF)
    rel = con.execute(suite.oracles[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in rel.description], rel.fetchall())


def test_all_are_registered():
    names = {n.split("_")[0] for n in suite.queries}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert set(suite.queries) | {"pipeline"} <= set(entry.queries())


def test_sharding_digest(spark, con):
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    rows = suite.queries["op1_sharding"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and {r["shard"] for r in rows} <= set(range(16))
    for r in rows:
        body = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 1, zlib.crc32(body), "rows", None)


def test_mixing_digest(spark, con):
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    rows = suite.queries["op2_mixing"](spark, SF).collect()
    assert all(r["size"] == len(texts[r["doc_id"]].encode().split()) and r["taken"] <= 2 * r["size"] for r in rows)
    assert len(rows) == len(texts)


def test_toxicity_digest(spark, con):
    rows = suite.queries["op4_toxicity"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_toxicity_ranks_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    rows = [r for r in suite.queries["op4_toxicity"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    good = sorted(r["score"] for r in rows if not labels[r["doc_id"]])
    bad = [r["score"] for r in rows if labels[r["doc_id"]]]
    wins = sum(sum(g < b for g in good) + 0.5 * sum(g == b for g in good) for b in bad)
    assert wins / (len(good) * len(bad)) > 0.95
    assert sum(g >= 0.3 for g in good) < 0.02 * len(good) and sum(b >= 0.3 for b in bad) > 0.85 * len(bad)


def test_secrets_digest(spark, con):
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    for r in suite.queries["op7_secrets"](spark, SF).collect():
        hexes = [(m.start(), m.end()) for m in re.finditer("[0-9a-f]+", texts[r["doc_id"]]) if len(m[0]) >= 24]
        base = [s for s in r["spans"].split(",") if s and not s.startswith("random")]
        assert r["n_hex"] == len(hexes) and [s for s in base if s.startswith("hex")] == [f"hex:{a}:{b}" for a, b in hexes]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()


def test_results_can_be_written(spark, tmp_path):
    df = suite.queries["op10_decontamination"](spark, SF)
    df.write.parquet(str(tmp_path / "out"))
    assert json.loads(spark.read.parquet(str(tmp_path / "out")).schema.json())["fields"][0]["name"] == "doc_id"
