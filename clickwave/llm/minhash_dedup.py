"""Near-duplicate documents by BagMinHash signatures of their word shingles.

A document is the multiset of its runs of five words (all its words, if it has
fewer).  BagMinHash gives a signature whose registers agree with probability
equal to the weighted Jaccard similarity of two multisets:

* weights are discretised at the integers and put into dyadic intervals
  (0, 1], (1, 2], (2, 4], (4, 8] ...; every shingle has a Poisson process of
  points in each interval, at a rate of the interval's length, that depends on
  shingle and interval alone;
* a point hits a random register and lies at a random integer of its interval
  (one bisection of the interval per bit); it counts for a document if the
  shingle occurs there at least so often;
* a register keeps its earliest point.  Points come in order, so a process
  stops at the first one that is later than all registers.

Signatures are cut into bands; documents that share a band are candidates, and
links are pairs whose multisets overlap by ``similarity`` or more, computed
from the texts.  Equal texts are one class and take part once.  With 24 bands
of 4 registers a pair at 0.8 is missed by all bands with probability 3e-6.

Candidates are verified in two rounds, so that a group of copies costs in
proportion to its size:

1. every member of a bucket against the bucket's smallest member;
2. in buckets whose members are not all connected by then, members of
   different components against each other, each pair in the first band that
   it shares and unless an earlier link has joined their components; pairs
   whose signatures agree most come first.

So every pair that shares a band is verified or already connected.

Scale: signatures are computed where documents are read.  Smallest members are
found by map-side aggregation; buckets of one document go there, so that both
rounds read back the others only.  Texts move once for each round: those of
documents that share a bucket while these are at most ``SMALL_IDS``, else all.
Buckets of round 2 over ``block`` members are cut into pairs of blocks.  Connected copies have
blocks of their own there, which meet the blocks of others only, so a text is
sent in proportion to the blocks of documents it is not connected with.

Defined results: null text is the empty text; texts without words are copies
of equal texts only; repeated rows (same id and text) are one document; an id
with several texts has the links of all of them; a row without an id is in the
class and component of equal texts that have ids (null if there are none) and
links nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwave.llm.common import small_side
from clickwave.llm.components import components
from clickwave.session import checkpoint_dir

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4  # rows of 16 bits: a band is a 64-bit key
BLOCK = 500
SMALL_IDS = 200_000
LEAD_BITS = 8
SLICE = 1 << LEAD_BITS
CACHED_WORDS = 300_000
_GOLD, _A, _B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_PRIME = np.uint64(0x100000001B3)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def shingles(words: list[str], hashes: _Hashes, n: int = WORDS) -> np.ndarray:
    """Hashes of the runs of ``n`` words; of all words if there are fewer."""
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not len(w):
        return w
    n = min(n, len(w))
    out = w[:len(w) - n + 1] * np.uint64(n)
    for k in range(1, n):
        out = out * _PRIME + w[k:len(w) - n + 1 + k]
    return _mix(out)


def bag_minhash(bags: list[np.ndarray], registers: int = BANDS * ROWS) -> np.ndarray:
    """Signatures (16 bits a register) of multisets of hashes; empty ones get zeros."""
    docs = len(bags)
    if not sum(map(len, bags)):
        return np.zeros((docs, registers), np.uint16)
    # distinct elements of each document with their counts: one sort of hashes led by the document's
    # number, for which every call, whatever its size, leaves the same bits
    if docs > 1 << LEAD_BITS:
        raise ValueError(f"at most {1 << LEAD_BITS} documents at a time")
    key = np.concatenate(bags) >> np.uint64(LEAD_BITS)
    key |= np.repeat(np.arange(docs, dtype=np.uint64) << np.uint64(64 - LEAD_BITS), [len(b) for b in bags])
    key.sort()
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    weight = np.diff(np.append(start, len(key)))
    key = key[start]
    doc = (key >> np.uint64(64 - LEAD_BITS)).astype(np.int64)
    element = key & np.uint64((1 << (64 - LEAD_BITS)) - 1)
    # one process for each element and dyadic interval up to its weight
    parts = [(np.arange(len(key)), 0)]
    level = 1
    while (more := np.flatnonzero(weight > 1 << (level - 1))).size:
        parts.append((more, level))
        level += 1
    row = np.concatenate([p for p, _ in parts])
    low = np.concatenate([np.full(len(p), 1 << (k - 1) if k else 0, np.int64) for p, k in parts])
    rate = np.maximum(low, 1)
    seed = _mix(element[row] + np.concatenate([np.full(len(p), (k + 1) * 0x632BE59BD9B4E019 & (2**64 - 1), np.uint64) for p, k in parts]))
    doc, weight = doc[row], weight[row]
    best = np.full(docs * registers, np.inf)
    latest = np.full(docs, np.inf)
    at = np.zeros(len(row))
    step = 0
    while len(at):
        step += 1
        draw = _mix(seed + np.uint64(step * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        at = at - np.log(((draw >> np.uint64(32)).astype(float) + 0.5) / 2.0**32) / rate
        go = at < latest[doc]
        if not go.all():
            at, seed, doc, weight, low, rate, draw = (x[go] for x in (at, seed, doc, weight, low, rate, draw))
        if not len(at):
            break
        register = ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        counts = low == 0
        if not counts.all():  # where in its interval the point lies, by bisection with random bits
            where = _mix(draw ^ _GOLD) & (rate - 1).astype(np.uint64)
            counts |= low + 1 + where.astype(np.int64) <= weight
        np.minimum.at(best, doc[counts] * registers + register[counts], at[counts])
        latest = best.reshape(docs, registers).max(1)
    best = best.reshape(docs, registers)
    value = (_mix(best.view(np.uint64)) >> np.uint64(48)).astype(np.uint16)
    value[~np.isfinite(best[:, 0])] = 0
    return value


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets of hashes (sorted arrays)."""
    if not len(a) or not len(b):
        return 0.0
    x, m = np.unique(a, return_counts=True)
    y, n = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(m[i], n[j]).sum())
    return both / (len(a) + len(b) - both)


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    small, large = sorted((len(a), len(b)))
    return small > 0 and small >= least * large and overlap(a, b) >= least - 1e-12


def _signer(n: int, schema: pa.Schema):
    def run(batches):
        hashes = _Hashes()
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                part = batch.slice(k, SLICE)
                bags = [shingles((t.as_py() or "").split(), hashes, n) for t in part.column(2)]
                keys = bag_minhash(bags).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([s if len(b) else None for s, b in zip(keys, bags)], pa.list_(pa.int64()))], schema=schema)
    return run


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).argmax(-1)


def _star_verifier(n: int, least: float, schema: pa.Schema):
    def run(batches):
        hashes, known = _Hashes(), ("", None)
        for batch in batches:
            keep = []
            for mine, other in zip(batch.column(2), batch.column(3)):
                a, b = mine.as_py(), other.as_py()
                if known[0] != b or known[1] is None:
                    known = b, shingles(b.split(), hashes, n)
                keep.append(similar(shingles(a.split(), hashes, n), known[1], least))
            out = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            if out.num_rows:
                yield pa.RecordBatch.from_arrays(out.columns, schema=schema)
    return run


def _cell_links(node, comp, block, bands, texts, band: int, split: bool, least: float, n: int, hashes: _Hashes) -> list:
    """Links between components among the members of one bucket (or pair of its blocks)."""
    order = np.argsort(node, kind="stable")
    node, comp, block, bands = node[order], comp[order], block[order], bands[order]
    root = {int(c): int(c) for c in comp}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c
    registers = bands.view(np.uint16).reshape(len(node), -1)
    bags: dict[int, np.ndarray] = {}

    def bag(i):
        if i not in bags:
            bags[i] = shingles((texts[order[i]].as_py() or "").split(), hashes, n)
        return bags[i]
    out = []
    for i in range(len(node) - 1):
        other = np.arange(i + 1, len(node))
        other = other[comp[other] != comp[i]]
        if split:
            other = other[block[other] != block[i]]
        if not len(other):
            continue
        other = other[_first_shared(bands[other], bands[i]) == band]
        agree = (registers[other] == registers[i]).mean(1)
        for j in other[np.argsort(-agree, kind="stable")]:
            x, y = find(int(comp[i])), find(int(comp[j]))
            if x != y and similar(bag(i), bag(int(j)), least):
                root[max(x, y)] = min(x, y)
                out.append((int(node[i]), int(node[j])))
        bags.pop(i, None)
    return out


def _cell_verifier(n: int, least: float, schema: pa.Schema):
    def run(batches):
        hashes, held, last = _Hashes(), [], None

        def done():
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
            held.clear()
            if rows.num_rows < 2:
                return None
            band, i, j = rows.column(0)[0].as_py(), rows.column(2)[0].as_py(), rows.column(3)[0].as_py()
            bands = rows.column(7).flatten().to_numpy().reshape(rows.num_rows, -1)
            links = _cell_links(rows.column(5).to_numpy(), rows.column(6).to_numpy(), rows.column(4).to_numpy(), bands,
                                rows.column(8), band, i != j, least, n, hashes)
            if not links:
                return None
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], schema=schema)

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(4)], 1)
            cut = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]))
            for a, b in zip(cut[:-1], cut[1:]):
                if held and (keys[a] != last).any():
                    out = done()
                    if out is not None:
                        yield out
                held.append(batch.slice(a, b - a))
                last = keys[a]
        if held:
            out = done()
            if out is not None:
                yield out
    return run


def _cells_of_large_buckets(near: DataFrame, block: int) -> DataFrame:
    """Members of buckets with more than ``block`` of them, in the pairs of
    blocks (``i, j``) whose documents are to be compared.

    A component with more than ``block`` members in a bucket has blocks of its
    own, the others share some.  Blocks of the same component are never
    paired: copies that are connected meet the outsiders, not each other.
    """
    per = near.groupBy("band", "key", "comp").agg(F.count(F.lit(1)).alias("c"))
    large = per.where(F.col("c") > block).select("band", "key", "comp", F.ceil(F.col("c") / block).alias("own"))
    shared = (per.where(F.col("c") <= block).groupBy("band", "key")
              .agg(F.ceil(F.sum("c") / block).alias("common")))
    part = F.when(F.col("own").isNotNull(), F.pmod(F.xxhash64("rep"), F.col("own"))).otherwise(
        F.pmod(F.xxhash64("comp"), F.col("common")))
    owner = F.when(F.col("own").isNotNull(), F.col("comp"))
    placed = (near.join(large, ["band", "key", "comp"], "left").join(shared, ["band", "key"], "left")
              .select("band", "key", "rep", "comp", owner.alias("owner"), F.xxhash64(owner, part).alias("block")))
    blocks = placed.select("band", "key", F.col("owner").alias("_owner"), F.col("block").alias("_block")).distinct()
    apart = F.col("owner").isNull() | F.col("_owner").isNull() | (F.col("owner") != F.col("_owner"))
    return (placed.join(blocks, ["band", "key"]).where(apart)
            .select("band", "key", F.least("block", "_block").alias("i"), F.greatest("block", "_block").alias("j"),
                    "block", "rep", "comp"))


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                   similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """One row per document: id, ``class_id`` (smallest id with an equal
    text), ``component_id`` (smallest id reachable by links), ``kept`` (the id
    is its component's smallest)."""
    rows = _assigned(docs, id_col, text_col, words, similarity, block).distinct()
    return rows.select(F.col("id").alias(id_col), "class_id", "component_id",
                       F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def _assigned(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float, block: int) -> DataFrame:
    """``id, fp, class_id, component_id`` of each row (repeated rows repeat)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    checkpoint_dir(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(text)).alias("fp"), text.alias("text"))
    signed = T.StructType([T.StructField("id", T.LongType()), T.StructField("fp", T.BinaryType()),
                           T.StructField("sig", T.ArrayType(T.LongType()))])
    rows = slim.mapInArrow(_signer(words, to_arrow_schema(signed)), signed)
    classes = (rows.groupBy("fp").agg(F.min("id").alias("rep"), F.first("sig").alias("sig"))
               .checkpoint())
    nodes = classes.where(F.col("rep").isNotNull() & F.col("sig").isNotNull()).select("rep", "sig")
    texts = slim.where(F.col("id").isNotNull()).select("id", "text")
    bands = nodes.select("rep", F.posexplode("sig").alias("band", "key"))
    pair = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    arrow_pair = to_arrow_schema(pair)

    # buckets of one document go, and texts of documents that are in no other
    least = (bands.groupBy("band", "key").agg(F.min("rep").alias("b"), F.max("rep").alias("top"))
             .where(F.col("top") > F.col("b")).drop("top"))
    met = bands.join(least, ["band", "key"]).checkpoint()
    meeting = small_side(met.select(F.col("rep").alias("_met")).distinct(), SMALL_IDS)
    texts = texts.join(meeting, F.col("id") == F.col("_met"), "left_semi")

    # round 1: members of a bucket against its smallest
    pairs = met.where(F.col("rep") != F.col("b")).select(F.col("rep").alias("a"), "b").distinct()
    first = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
             .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
             .select("a", "b", "ta", "tb")
             .mapInArrow(_star_verifier(words, similarity, arrow_pair), pair).distinct().checkpoint())

    # round 2: what is still apart within a bucket
    comp = components(first)
    placed = (met.join(comp, F.col("rep") == F.col("node"), "left")
              .select("rep", "band", "key", F.coalesce("component", "rep").alias("comp")))
    apart = (placed.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                              F.count(F.lit(1)).alias("n"))
             .where(F.col("lo") < F.col("hi")).select("band", "key", "n"))
    near = placed.join(apart, ["band", "key"])
    zero = F.lit(0).cast("long")
    member = (near.where(F.col("n") <= block)
              .select("band", "key", zero.alias("i"), zero.alias("j"), zero.alias("block"), "rep", "comp")
              .unionByName(_cells_of_large_buckets(near.where(F.col("n") > block), block)))
    cells = (member.join(nodes.withColumnRenamed("rep", "_r"), F.col("rep") == F.col("_r"))
             .join(texts.select(F.col("id").alias("_i"), "text"), F.col("rep") == F.col("_i"))
             .select("band", "key", "i", "j", "block", "rep", "comp", "sig", "text")
             .repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j"))
    second = cells.mapInArrow(_cell_verifier(words, similarity, arrow_pair), pair).distinct()

    named = slim.select("id", "fp").join(classes.select("fp", "rep"), "fp")
    # ids with several texts: each of their classes with the smallest
    smallest = (named.where(F.col("id").isNotNull()).groupBy(F.col("id").alias("_id"))
                .agg(F.min("rep").alias("b"), F.max("rep").alias("top")).where(F.col("top") > F.col("b")))
    several = (named.join(smallest, F.col("id") == F.col("_id")).where(F.col("rep") != F.col("b"))
               .select(F.col("rep").alias("a"), "b").distinct())
    links = first.unionByName(second).unionByName(several).checkpoint()
    final = components(links)
    return (named.join(final, F.col("rep") == F.col("node"), "left")
            .select("id", "fp", F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id")))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                      similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """The row of each component's smallest id (one row if it repeats), with
    the columns of ``docs``.  Rows without an id go if a row with an id has an
    equal text, and stay otherwise.

    Texts do not move for this: the ids that go or repeat are joined to the
    rows, broadcast while there are at most ``SMALL_IDS`` of them.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    per_id = (_assigned(docs, id_col, text_col, words, similarity, block).where(F.col("id").isNotNull())
              .groupBy(F.col("id").alias("_id"))
              .agg(F.min("component_id").alias("_component"), F.min("fp").alias("_fp"), F.count(F.lit(1)).alias("_rows")))
    special = small_side(per_id.where((F.col("_component") != F.col("_id")) | (F.col("_rows") > 1))
                         .select("_id", "_fp", (F.col("_component") == F.col("_id")).alias("_kept")), SMALL_IDS)
    rows = docs.select(row, F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(text)).alias("fp"))
    single = (rows.where(F.col("id").isNotNull()).join(special, F.col("id") == F.col("_id"), "left_anti").select("row"))
    repeated = (rows.join(special.where("_kept"), (F.col("id") == F.col("_id")) & (F.col("fp") == F.col("_fp")))
                .dropDuplicates(["id"]).select("row"))
    known = rows.where(F.col("id").isNotNull()).select(F.col("fp").alias("_known")).distinct()
    nameless = rows.where(F.col("id").isNull()).join(known, F.col("fp") == F.col("_known"), "left_anti").select("row")
    return single.unionByName(repeated).unionByName(nameless).select("row.*")
