"""The pipeline's stages over a small folder of tables, and the registration."""

import os
import random
import zlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.fixtures import awkward, documents, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    clean = [(200 + k, prose(rng, rng.randint(30, 200)), rng.choice("abc")) for k in range(150)]
    toxic = [(1000 + k, f"{prose(rng, 40)} {rng.choice(['lout', 'grobian'])} {prose(rng, 40)}", "a") for k in range(80)]
    copies = [(2000 + k, clean[k % 3][1], "b") for k in range(9)]
    near = [(3000 + k, clean[10][1] + " " + prose(rng, 2), "c") for k in range(4)]
    lines = [(4000 + k, f"{prose(rng, 60)}\nShared footer of all these pages, number {k}", "c") for k in range(12)]
    rows = awkward() + clean + toxic + copies + near + lines
    rng.shuffle(rows)
    d = str(tmp_path_factory.mktemp("tables"))
    documents(spark, rows).write.parquet(f"{d}/documents.parquet")
    learn = [(i, 0, 1) for i, _, _ in toxic] + [(i, 1, 0) for i, _, _ in clean]
    spark.createDataFrame(learn, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, {"clean": clean, "toxic": toxic, "copies": copies, "near": near, "lines": lines, "rows": rows}


def test_stages(spark, folder):
    d, made = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        seen[name] = docs = docs.cache()
        assert name == "packing" or docs.columns == columns
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in seen.items()}
    toxic = {i for i, _, _ in made["toxic"]}
    assert sorted(map(str, ids["toxicity"])) == sorted(str(i) for i, _, _ in made["rows"] if i not in toxic)
    assert sorted(map(str, ids["line_dedup"])) == sorted(map(str, ids["toxicity"]))
    left = [r.text for r in seen["line_dedup"].collect() if r.text and "Shared footer" in r.text]
    assert len(left) == 1
    kept = set(ids["minhash_dedup"])
    assert not kept & {i for i, _, _ in made["copies"]} and {i for i, _, _ in made["clean"]} <= kept
    assert not kept & {i for i, _, _ in made["near"]} and {i for i, _, _ in made["lines"]} <= kept
    assert set(ids["mixing"]) <= kept and set(ids["packing"]) == set(ids["mixing"])


def test_run_gives_the_last_stage(spark, folder):
    d, _ = folder
    out = corpus_pipeline.run(spark, d)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d).cache()
    digest = lambda df: sorted(map(str, df.select("doc_id", "start", "length", "ids_crc32").collect()))
    pieces = digest(out)
    assert len(pieces) > 100 and abs(len(pieces) - docs.count()) < 0.1 * len(pieces)
    total = lambda df: {r.doc_id: r["sum(length)"] for r in df.groupBy("doc_id").sum("length").collect()}
    assert total(out) == total(docs)


def test_empty_tables(spark, folder, tmp_path):
    d, _ = folder
    for t in ("documents", "labels"):
        spark.read.parquet(f"{d}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registration():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(entry.oracle_sql()[name]).fetchall()
    columns = [c[0] for c in con.description]
    got = entry.queries()[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want))


