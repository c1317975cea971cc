"""Near-duplicate embeddings by cross-polytope hashing with multiprobe buckets.

A vector, padded to a power of two, is rotated pseudo-randomly by three rounds
of random signs and a fast Hadamard transform; its hash is the largest
coordinate with its sign.  A table joins ``hashes`` of them.  Besides its own
bucket a vector enters the next best ones of each table (``probes`` in all,
those that cost least in squared distance to the largest coordinates), so two
vectors meet if either's own bucket is among the other's.  All pairs that meet
are verified by their cosine in double precision.

Equal vectors are one class with a number of members.  A pair that meets in
several buckets is counted in the first of them only, which both members'
hashes tell, so no list of pairs is built: a bucket gives one row for each
member that has links, with their number and the smallest member it is
connected to.  Components follow from these rows.

With 6 tables of 2 hashes and 3 probes, pairs of cosine 0.95 in 64 dimensions
met in more than 0.999 of simulated cases.

Scale: a bucket of more than ``block`` entries is cut into blocks by a hash of
the member, and each pair of blocks is a piece of work of its own, so no task
holds more than two blocks.  Within a task, buckets stream by in sorted order.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different length never link; repeated
rows (same id and vector) are one vector; an id with several vectors gives a
row for each, with one component; a null id links with nothing and has no
component; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwave.llm.common import small_side
from clickwave.llm.components import components
from clickwave.session import checkpoint_dir

COSINE = 0.95
TABLES, HASHES, PROBES = 6, 2, 3
BLOCK = 2048
HOT_BUCKETS = 100_000
SEED = 7


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows (their length a power of two)."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def codes(vectors: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES,
          seed: int = SEED) -> np.ndarray:
    """Bucket codes, (vectors, tables, probes); the first probe is the own bucket."""
    n, dim = vectors.shape
    d = 1 << max(1, dim - 1).bit_length()
    x = np.zeros((n, d))
    x[:, :dim] = vectors
    near = min(3, d)
    combos = [c for c in product(range(near), repeat=hashes) if sum(c) <= 2]
    out = np.empty((n, tables, min(probes, len(combos))), np.int64)
    for t in range(tables):
        cost, code = np.zeros((n, len(combos))), np.zeros((n, len(combos)), np.int64)
        for h in range(hashes):
            signs = np.random.default_rng((seed, dim, t, h)).choice((-1.0, 1.0), (3, d))
            y = x
            for s in signs:
                y = hadamard(y * s)
            size = np.abs(y)
            top = np.argpartition(-size, near - 1, axis=1)[:, :near]
            order = np.argsort(-np.take_along_axis(size, top, 1), axis=1, kind="stable")
            top = np.take_along_axis(top, order, 1)
            at = np.take_along_axis(size, top, 1)
            value = 2 * top + (np.take_along_axis(y, top, 1) > 0)
            pick = [c[h] for c in combos]
            cost += (at[:, :1] - at[:, pick]) ** 2
            code = code * (2 * d) + value[:, pick]
        best = np.argsort(cost, axis=1, kind="stable")[:, :out.shape[2]]
        out[:, t] = np.take_along_axis(code, best, 1)
    return out


def _first_meeting(a: np.ndarray, b: np.ndarray, table: int, code: int) -> np.ndarray:
    """Whether pairs (rows of ``a`` and ``b``: their codes) meet in this bucket and in none before."""
    far = np.iinfo(np.int64).max
    ok = np.ones(len(a), bool)
    for t in range(table):
        ok &= ~((a[:, t, :1] == b[:, t]).any(1) | (b[:, t, :1] == a[:, t]).any(1))
    own_a = np.where((a[:, table, :1] == b[:, table]).any(1), a[:, table, 0], far)
    own_b = np.where((b[:, table, :1] == a[:, table]).any(1), b[:, table, 0], far)
    return ok & (np.minimum(own_a, own_b) == code)


def _links(vectors, members, known, block, same: bool, table: int, code: int, cosine: float):
    """Links counted in one bucket (or pair of blocks): for each entry their
    number, in members, and the smallest entry it is connected to here.
    ``known``: the codes of the entries."""
    n = len(vectors)
    count, root = np.zeros(n, np.int64), np.arange(n)
    left, right = (np.arange(n), None) if same else (np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max()))
    for k in range(0, len(left), 256):
        rows = left[k:k + 256]
        others = np.arange(rows[0] + 1, n) if right is None else right
        hit = vectors[rows] @ vectors[others].T >= cosine
        if right is None:
            hit &= others[None, :] > rows[:, None]
        i, j = np.nonzero(hit)
        i, j = rows[i], others[j]
        for c in range(0, len(i), 100_000):
            a, b = i[c:c + 100_000], j[c:c + 100_000]
            ok = _first_meeting(known[a], known[b], table, code)
            a, b = a[ok], b[ok]
            np.add.at(count, a, members[b])
            np.add.at(count, b, members[a])
            _join(root, a, b)
    while True:
        up = root[root]
        if (up == root).all():
            return count, root
        root = up


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the trees of linked entries; roots are their smallest entries."""
    while len(a):
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up
        x, y = root[a], root[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        if len(x):
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))


def _hasher(hashing: dict, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            rep, h, members, vectors = batch.columns
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                x = flat[starts[rows][:, None] + np.arange(dim)].astype(float)
                x /= np.abs(x).max(1, keepdims=True)
                code = codes(x / np.linalg.norm(x, axis=1, keepdims=True), **hashing)
                n, t, p = code.shape
                # the probes of a table differ, so a vector is in a bucket once
                at = np.repeat(rows, t * p)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n * t * p, dim), pa.int32()),
                    pa.array(np.tile(np.repeat(np.arange(t), p), n), pa.int32()),
                    pa.array(code.reshape(-1), pa.int64()),
                    rep.take(pa.array(at)), h.take(pa.array(at)), members.take(pa.array(at)), vectors.take(pa.array(at)),
                    pa.array(list(code.reshape(n, t * p))).take(pa.array(np.repeat(np.arange(n), t * p)))], schema=schema)
    return run


def _verifier(cosine: float, tables: int, schema: pa.Schema):
    """Links within buckets, from entries sorted by bucket."""

    def verified(rows: pa.RecordBatch, keys: np.ndarray, cut: np.ndarray):
        block, rep, h, members = (rows.column(k).to_numpy() for k in (5, 6, 7, 8))
        flat = rows.column(9).flatten().to_numpy(zero_copy_only=False)
        known = rows.column(10).flatten().to_numpy().reshape(len(rep), tables, -1)
        ends = np.cumsum(keys[:, 0])
        out = []
        # vectors of one length follow each other, so they are one matrix
        for dim in np.unique(keys[:, 0]):
            at = np.flatnonzero(keys[:, 0] == dim)
            x = flat[ends[at[0]] - dim:ends[at[-1]]].astype(float).reshape(-1, dim)
            x /= np.abs(x).max(1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            first = at[0]
            for a, b in zip(cut[:-1], cut[1:]):
                if b - a < 2 or not first <= a <= at[-1]:
                    continue
                v = x[a - first:b - first]
                if b - a <= 256 and np.count_nonzero(v @ v.T >= cosine) <= b - a:
                    continue  # none but the vectors themselves
                _, table, code, i, j = keys[a]
                if i != j and (block[a:b] == block[a]).all():
                    continue
                order = np.argsort(rep[a:b], kind="stable")
                count, root = _links(v[order], members[a:b][order], known[a:b][order], block[a:b][order], i == j,
                                     int(table), int(code), cosine)
                some = np.flatnonzero(count)
                if len(some):
                    out.append((rep[a:b][order][some], h[a:b][order][some], count[some], rep[a:b][order][root[some]]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    def run(batches):
        held = None  # the last bucket may go on in the next batch
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            keys = np.stack([batch.column(k).to_numpy() for k in range(5)], 1)
            cut = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1))
            last = int(cut[-1])
            held = batch.slice(last)
            if last:
                yield from verified(batch.slice(0, last), keys[:last], cut)
        if held is not None and held.num_rows > 1:
            keys = np.stack([held.column(k).to_numpy() for k in range(5)], 1)
            yield from verified(held, keys, np.array([0, len(keys)]))
    return run


def near_embeddings(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                    tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    checkpoint_dir(df.sparkSession)
    hashing = {"tables": tables, "hashes": hashes, "probes": probes}
    v = F.col("v")
    fine = F.coalesce(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0), F.lit(False))
    kind = df.schema[vector_col].dataType
    if kind != T.ArrayType(T.FloatType()):  # floats are exact as doubles, and half the size on the way
        kind = T.ArrayType(T.DoubleType())
    rows = (df.select(F.col(id_col).alias("id"), F.col(vector_col).cast(kind).alias("v"))
            .distinct().withColumn("fine", fine).withColumn("h", F.xxhash64("v")))
    # classes of equal vectors
    good = rows.where("fine").select("id", "v", "h")
    classes = good.groupBy("h", "v").agg(F.min("id").cast("long").alias("rep"), F.count(F.lit(1)).alias("members")).checkpoint()
    entry = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("tab", T.IntegerType()),
                          T.StructField("code", T.LongType()), T.StructField("rep", T.LongType()),
                          T.StructField("h", T.LongType()), T.StructField("members", T.LongType()),
                          T.StructField("v", kind), T.StructField("codes", T.ArrayType(T.LongType()))])
    entries = classes.select("rep", "h", "members", "v").mapInArrow(
        _hasher(hashing, to_arrow_schema(entry)), entry)
    # buckets over the block size, cut into blocks
    key = ["dim", "tab", "code"]
    hot = small_side(entries.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
                     .select(*[F.col(k).alias("_" + k) for k in key], F.ceil(F.col("n") / block).cast("int").alias("blocks")),
                     HOT_BUCKETS)
    on = (F.col("dim") == F.col("_dim")) & (F.col("tab") == F.col("_tab")) & (F.col("code") == F.col("_code"))
    cut = (entries.join(hot, on, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
           .withColumn("mine", F.pmod(F.xxhash64("rep", "h", F.lit(SEED)), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select(*key, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                   F.col("mine").alias("block"), "rep", "h", "members", "v", "codes"))
    part = key + ["i", "j"]
    found = T.StructType([T.StructField(c, T.LongType()) for c in ("rep", "h", "n", "root")])
    links = (cut.repartition(*[F.col(c) for c in part]).sortWithinPartitions(*part)
             .mapInArrow(_verifier(cosine, tables, to_arrow_schema(found)), found)
             .groupBy("rep", "h", "root").agg(F.sum("n").alias("n")).checkpoint())
    # an id with several vectors joins their classes
    several = (good.join(classes.select("h", "v", "rep"), ["h", "v"]).groupBy("id").agg(F.collect_set("rep").alias("reps"))
               .where(F.size("reps") > 1).select(F.explode("reps").alias("a"), F.array_min("reps").alias("b")))
    comp = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(several))
    counts = links.groupBy(F.col("rep").alias("_r"), F.col("h").alias("_h")).agg(F.sum("n").alias("n"))
    member = classes.select("h", "v", "rep", "members")
    out = (rows.join(member, ["h", "v"], "left")
           .join(counts, (F.col("rep") == F.col("_r")) & (F.col("h") == F.col("_h")), "left")
           .join(comp, F.col("rep") == F.col("node"), "left"))
    own = F.when(F.col("fine"), F.coalesce("component", "rep")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("fine"), F.coalesce("n", F.lit(0)) + F.col("members") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        own.cast("long").alias("component_id"),
        F.coalesce(own == F.col("id"), F.lit(True)).alias("kept"))
