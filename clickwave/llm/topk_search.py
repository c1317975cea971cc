"""Exact top-k inner-product search with block-at-a-time pruning.

Vectors are cut into document-range blocks; a block keeps, for every term
(dimension), its largest and smallest value, and its forward index (the values
of its documents).  For a query the most that a document of a block can score
is the sum over terms of the query's value times the block's maximum (or, for a
negative value, its minimum).  Blocks are scored in descending order of that
bound until it falls below the k-th best score so far; a bound equal to it is
still scored, as ties go to the smaller id.

Scale: documents are dealt into chunks by a hash and, within a chunk, ordered
by their strongest terms, so that blocks are ranges of similar documents.
Queries are a stated set, cut into blocks of their own; every pair of a chunk
and a query block is a task's piece of work of fixed size.  Each query starts
from the k-th best score over a bounded sample of documents, a lower bound of
its final one, so cells give only candidates that can still win; the merge
keeps k rows per query with a partial group limit before its shuffle.

Defined results: vectors that are null, empty or hold null or non-finite
components, and rows with a null id, take no part; vectors of different
length do not meet; repeated rows (same id and vector) count once; an id with
several vectors is a candidate (and a query) with each of them, and all rows
with a query's id are its own; ties go to the smaller id; fewer than k
candidates give all of them; an empty table gives no rows; other columns are
not read.  Scores are exact: vectors of a norm from ``WILD`` on, whose products
doubles may not hold, are scored one by one in integers, and a score beyond a
long is given (and ranked) as the nearest long.
"""

from __future__ import annotations

from heapq import nsmallest
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SCALE = 1024
K = 10
BLOCK = 64
CHUNK, QUERIES = 8192, 4096
SAMPLE = 2000
#: Products of vectors of a smaller norm, and their sums, stay below 2**52.
WILD = 2.0 ** 26
_LEAST = -(1 << 63)


def finite(v: Column) -> Column:
    return F.coalesce(
        v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
        F.lit(False))


def quantised(v: Column, scale: int = SCALE) -> Column:
    """Floors as doubles; from 2**53 on every double is an integer already."""
    def floor(x):
        y = x * F.lit(float(scale))
        return F.when(F.abs(y) < F.lit(2.0 ** 53), F.floor(y).cast("double")).otherwise(y)
    return F.transform(v.cast("array<double>"), floor)


def wild(vectors: np.ndarray) -> np.ndarray:
    """Which vectors are too long for products in doubles."""
    return np.hypot.reduce(vectors, axis=1) >= WILD


def search_wild(ids: np.ndarray, docs: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int = K):
    """The k best ``(query number, id, score)`` of each query, in integers."""
    found, ints = [], [[int(x) for x in v] for v in docs.tolist()]
    for n, q in enumerate(queries.tolist()):
        q = [int(x) for x in q]
        score = ((sum(map(mul, v, q)), i) for v, i in zip(ints, ids.tolist()) if i != query_ids[n])
        score = ((-min(max(s, _LEAST), -_LEAST - 1), i) for s, i in score)
        found += [(n, i, -s) for s, i in nsmallest(k, score)]
    return found


def block_bounds(queries: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Most that any document of each block can score, (queries, blocks)."""
    return np.maximum(queries, 0) @ top.T + np.minimum(queries, 0) @ low.T


def search(ids: np.ndarray, docs: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray,
           k: int = K, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Candidates ``(query number, id, score)`` with at least the score
    ``floor`` of their query, the k best of each query among them, and the
    number of (query, block) pairs that were scored."""
    order = np.lexsort((ids, *_strongest(docs)))
    ids, docs = ids[order], docs[order]
    n, nq = len(ids), len(queries)
    blocks = -(-n // block)
    cut = np.arange(blocks) * block
    bounds = block_bounds(queries, np.maximum.reduceat(docs, cut), np.minimum.reduceat(docs, cut))
    rank = np.argsort(-bounds, axis=1, kind="stable")
    best = np.full((nq, k), -np.inf)
    best_id = np.full((nq, k), np.iinfo(np.int64).max)
    kth = floor.copy()
    pad = blocks * block - n
    forward = np.concatenate((docs, np.zeros((pad, docs.shape[1])))).reshape(blocks, block, -1)
    names = np.concatenate((ids, np.full(pad, -1))).reshape(blocks, block)
    real = np.concatenate((np.ones(n, bool), np.zeros(pad, bool))).reshape(blocks, block)
    active, scored = np.arange(nq), 0
    for step in range(blocks):
        at = rank[active, step]
        go = bounds[active, at] >= kth[active]
        active, at = active[go], at[go]
        if not len(active):
            break
        scored += len(active)
        for part in range(0, len(active), 1024):
            q, b = active[part:part + 1024], at[part:part + 1024]
            score = np.matmul(forward[b], queries[q][:, :, None])[:, :, 0]
            score = np.where(real[b] & (names[b] != query_ids[q][:, None]), score, -np.inf)
            score = np.concatenate((best[q], score), 1)
            name = np.concatenate((best_id[q], names[b]), 1)
            pick = np.lexsort((name, -score), axis=1)[:, :k]
            best[q], best_id[q] = np.take_along_axis(score, pick, 1), np.take_along_axis(name, pick, 1)
            kth[q] = np.maximum(kth[q], best[q, -1])
    i, j = np.nonzero(best >= np.maximum(floor, np.finfo(float).min)[:, None])
    return i, best_id[i, j], best[i, j], scored


def _strongest(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys that put documents with the same two strongest terms (and signs) together."""
    d = docs.shape[1]
    size = np.abs(docs)
    first = size.argmax(1)
    rows = np.arange(len(docs))
    size[rows, first] = -1
    second = size.argmax(1) if d > 1 else first
    sign = lambda at: 2 * at + (docs[rows, at] > 0)
    return sign(second), sign(first)


def _matrix(values) -> np.ndarray:
    return np.array(values.tolist(), dtype=float).reshape(len(values), -1)


def top_k(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          scale: int = SCALE, chunk: int = CHUNK, queries: int = QUERIES, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k best rows;
    ``is_query`` is a condition on the id, named ``id``."""
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
            .where(F.col("id").isNotNull() & finite(F.col("v"))).select("id", quantised(F.col("v"), scale).alias("v")).distinct())
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    chunks, parts = max(1, -(-n // chunk)), max(1, -(-n_queries // queries))
    where = F.xxhash64("id", "v")
    asked = rows.where(is_query).select(F.col("id").alias("qid"), F.col("v").alias("q"))

    # a lower bound of each query's k-th score, from a bounded sample of rows
    seed_rows = [(r.id, r.v) for r in rows.orderBy(where, "id").limit(sample).collect()]

    def with_floor(batches):
        by_dim: dict[int, tuple] = {}
        for i, v in seed_rows:
            by_dim.setdefault(len(v), ([], []))[0].append(i)
            by_dim[len(v)][1].append(v)
        held = {}
        for d, (i, v) in by_dim.items():
            i, v = np.array(i), np.array(v, float)
            tame = ~wild(v)
            held[d] = i[tame], v[tame]
        for pdf in batches:
            floors = np.full(len(pdf), -np.inf)
            dims = pdf["q"].map(len).to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                ids, docs = held.get(d, (np.empty(0, np.int64), np.empty((0, d))))
                if len(ids) > k:
                    for c in range(0, len(at), 512):
                        part = at[c:c + 512]
                        asked = _matrix(pdf["q"].iloc[part])
                        part, asked = part[~wild(asked)], asked[~wild(asked)]
                        score = asked @ docs.T
                        score[ids[None, :] == pdf["qid"].to_numpy()[part][:, None]] = -np.inf
                        floors[part] = np.partition(score, -k, axis=1)[:, -k]
            yield pdf.assign(floor=floors)
    asked = asked.mapInPandas(with_floor, "qid long, q array<double>, floor double")
    asked = asked.withColumn("part", F.pmod(F.xxhash64("qid", "q"), F.lit(parts)).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    docs = rows.withColumn("chunk", F.pmod(where, F.lit(chunks)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for d in np.intersect1d(left["v"].map(len), right["q"].map(len)):
            a, b = left[left["v"].map(len) == d], right[right["q"].map(len) == d]
            ids, vectors, qid, asked = a["id"].to_numpy(), _matrix(a["v"]), b["qid"].to_numpy(), _matrix(b["q"])
            floor, odd, odd_q = b["floor"].to_numpy(float), wild(vectors), wild(asked)
            if not odd.all() and not odd_q.all():
                i, name, score, _ = search(ids[~odd], vectors[~odd], qid[~odd_q], asked[~odd_q], floor[~odd_q], k)
                out.append(pd.DataFrame({"query_id": qid[~odd_q][i], "vec_id": name, "score": score.astype(np.int64)}))
            for which, these in ((odd, ~odd_q), (np.ones(len(ids), bool), odd_q)):
                if which.any() and these.any():
                    some = search_wild(ids[which], vectors[which], qid[these], asked[these], k)
                    out.append(pd.DataFrame({"query_id": [qid[these][n] for n, _, _ in some],
                                             "vec_id": [i for _, i, _ in some], "score": [s for _, _, s in some]}, dtype="int64"))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
    found = (docs.groupBy("chunk", "part").cogroup(asked.groupBy("chunk", "part"))
             .applyInPandas(cell, "query_id long, vec_id long, score long"))
    ranked = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
