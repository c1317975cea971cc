"""Embedding near-duplicates and top-k search against brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwave.llm import embedding_dedup, topk_search
from clickwave.llm.catalog import ORACLES
from tests.llm.fixtures import with_clashing

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def vectors(seed=1, groups=25, dim=64):
    """Groups of close vectors, exact copies, and rows that link with nothing."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 8))):
            rows.append((base + rng.normal(size=dim) * rng.uniform(0, 0.33)).astype(np.float32).tolist())
    big = rng.normal(size=dim)
    rows += [(big + 0.05 * rng.normal(size=dim)).astype(np.float32).tolist() for _ in range(70)]
    rows += [rows[0]] * 3 + [rows[5]]
    ids = rng.permutation(len(rows)) * 5
    out = [(int(i), v, 0) for i, v in zip(ids, rows)]
    out += [(9001, None, 0), (9002, [0.0] * dim, 0), (9003, [NAN] + [1.0] * (dim - 1), 0), (9004, [INF] + [1.0] * (dim - 1), 0),
            (9005, [None] + [1.0] * (dim - 1), 0), (9006, [], 0), (9007, rows[0][:-1], 0), (9008, [3e38] * dim, 0), out[2], out[2]]
    return out


@pytest.fixture(scope="module")
def duck():
    return lambda df: _tables(df)


def _tables(df):
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [list(r)[:3] for r in df.select("vec_id", "embedding", "label").collect()])
    return con


@pytest.mark.parametrize("block", [16, 2048])
def test_links_and_components_match_all_pairs(spark, duck, block):
    df = with_clashing(spark.createDataFrame(vectors(), SCHEMA))
    got = sorted(map(tuple, embedding_dedup.near_embeddings(df, block=block).collect()))
    assert got == sorted(map(tuple, duck(df).execute(ORACLES["op2_embedding_dedup"]).fetchall()))


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    u, w = rng.normal(size=(2, 2000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    a, b = embedding_dedup.codes(u), embedding_dedup.codes(0.95 * u + np.sqrt(1 - 0.95 ** 2) * w)
    met = ((a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)).any(1)
    assert met.mean() >= 0.995


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(3).normal(size=(5, 64))
    y = embedding_dedup.hadamard(x)
    assert np.allclose(y @ y.T, x @ x.T) and np.allclose(embedding_dedup.hadamard(y), x)


def test_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 0), (4, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (7, [1.0], 0)], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_embeddings(df).collect()}
    assert got == {None: (0, None, True), 4: (1, 2, False), 2: (1, 2, True), 7: (0, 7, True)}
    empty = spark.createDataFrame([], SCHEMA)
    assert embedding_dedup.near_embeddings(empty).count() == 0
    assert topk_search.top_k(empty, F.col("id") % 100 == 0).count() == 0


@pytest.mark.parametrize("chunk, queries", [(40, 2), (8192, 4096)])
def test_top_k_matches_all_pairs(spark, duck, chunk, queries):
    df = with_clashing(spark.createDataFrame([r for r in vectors() if r[0] != 9008], SCHEMA))  # scores beyond a long
    got = topk_search.top_k(df, F.col("id") % 100 == 0, chunk=chunk, queries=queries, sample=30)
    want = duck(df).execute(ORACLES["op3_topk_search"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("chunk, queries", [(8, 2), (8192, 4096)])
def test_scores_beyond_doubles_and_longs(spark, chunk, queries):
    rng = np.random.default_rng(6)
    rows = [(k * 20, rng.normal(size=8).tolist()) for k in range(40)]
    rows += [(10_000 + k * 50, (rng.normal(size=8) * 10.0 ** (4 + k % 5)).tolist()) for k in range(30)]
    rows += [(20_000, [1e16] * 8), (20_100, [-1e20] * 8), (20_200, [1e16 + 2] * 7 + [-1.0]), (20_300, [3e38] * 8)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int")
    got = topk_search.top_k(df, F.col("id") % 100 == 0, chunk=chunk, queries=queries, sample=30)
    low, high = -(1 << 63), (1 << 63) - 1
    ints = {i: [int(np.floor(x * 1024.0)) for x in v] for i, v in rows}
    want = []
    for q in (i for i in ints if i % 100 == 0):
        score = sorted((-min(max(sum(a * b for a, b in zip(ints[q], v)), low), high), i) for i, v in ints.items() if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(score[:10])]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_few_candidates_and_ties(spark):
    df = spark.createDataFrame([(k * 100, [1.0, -0.5], 0) for k in range(4)], SCHEMA)
    got = topk_search.top_k(df, F.col("id") % 100 == 0).where("query_id = 200").orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in got] == [(1, 0, 1024 ** 2 + 512 ** 2), (2, 100, 1024 ** 2 + 512 ** 2), (3, 300, 1024 ** 2 + 512 ** 2)]


def test_blocks_are_pruned_and_bounds_hold():
    rng = np.random.default_rng(4)
    docs = np.floor(np.repeat(rng.normal(size=(40, 32)) * 300, 64, axis=0) + rng.normal(size=(2560, 32)) * 20)
    ids, q = np.arange(2560), docs[::200]
    i, found, score, scored = topk_search.search(ids, docs, ids[::200], q, np.full(len(q), -np.inf))
    assert scored < 0.3 * len(q) * 40
    for n in range(len(q)):
        s = docs @ q[n]
        s[n * 200] = -np.inf
        want = np.lexsort((ids, -s))[:10]
        assert sorted(zip(found[i == n], score[i == n])) == sorted(zip(ids[want], s[want]))
