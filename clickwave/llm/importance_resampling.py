"""Importance resampling towards a target text collection, on hashed n-grams.

All texts of a batch are joined by a separator that no word can hold, and one
pass of a pattern finds the words of all of them.  Binary search in the
offsets of the documents gives the document of every word; an n-gram is counted
if its first and last word are of the same one, which masks those across
separators, and ``bincount`` adds up its bucket.  Words are looked up by the
bytes of the text: all bytes of characters beyond ASCII are word bytes.

The corpus holds ``S`` features, ``s`` of them in a bucket, the target texts
``T`` and ``t``; the bucket's gain is ``floor(scale * ln((t+1)(S+B) /
((s+1)(T+B))))``.  A document weighs the sum of its features' gains.  Gumbel
noise drawn from a hash of its id is added, and the documents of highest score
are drawn, as many as ``percent`` of those with at least ``min_words`` words:
a sample without replacement with odds by weight.

Scale: counts leave a task as one row a bucket (``buckets`` rows at most), so
both count passes shuffle next to nothing; the table of gains has ``buckets``
rows, whatever the input, and goes to the tasks with the code.  Scored
documents are five numbers each; they are written to the checkpoint folder,
dealt by ranges of (score, id), ranked inside a range, and shifted by the
number of rows in the ranges before, so that no task ranks all of them.

Defined results: null text has no words; a document without features weighs 0;
texts below ``min_words`` words have a score but are never drawn; a null id is
hashed as an empty string and comes after all other ids; rows that repeat an id
are scored and drawn as documents of their own; with no target text, or no
documents, gains follow the same formula; an empty table gives no rows; extra
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickwave.session import checkpoint_dir

BUCKETS, SCALE, PERCENT, MIN_WORDS, SEED = 10_000, 1000, 10, 20, "2024:"
#: Words are lower-case letters, digits and everything beyond ASCII; what is
#: matched is the bytes of the text in UTF-8, its ASCII letters lowered.
_WORD = re.compile(rb"([0-9a-z\x80-\xff]+)")
_SEPARATOR = b"\x00"
#: Different features whose buckets a task remembers.
_REMEMBERED = 500_000


class Buckets(dict):
    """Bucket of a feature by the CRC-32 of its bytes; forgets when full."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def of(self, features: list[bytes]) -> np.ndarray:
        try:
            return np.fromiter(map(self.__getitem__, features), np.int64, len(features))
        except KeyError:
            if len(self) > _REMEMBERED:
                self.clear()
            for f in set(features) - self.keys():
                self[f] = zlib.crc32(f) % self.buckets
            return np.fromiter(map(self.__getitem__, features), np.int64, len(features))


def batch_features(texts: pa.Array, max_n: int, buckets: Buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and bucket of every feature of a batch, and words by document."""
    raw = [b"" if t is None else t.lower() for t in texts.cast(pa.binary()).to_pylist()]
    starts = np.cumsum([0] + [len(t) + 1 for t in raw])[:-1]
    parts = _WORD.split(_SEPARATOR.join(raw))  # between words, word, between words, ...
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    words = parts[1::2]
    doc = np.searchsorted(starts, ends[:-1:2], side="right") - 1
    docs, found = [doc], [buckets.of(words)]
    for n in range(2, max_n + 1):
        same = np.flatnonzero(doc[:len(doc) - n + 1] == doc[n - 1:]) if len(doc) >= n else np.empty(0, np.int64)
        docs.append(doc[same])
        found.append(buckets.of([b" ".join(words[i:i + n]) for i in same.tolist()]))
    return np.concatenate(docs), np.concatenate(found), np.bincount(doc, minlength=len(raw))


def bucket_counts(texts: DataFrame, text_col: str = "text", max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features of all texts by bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch_features(batch.column(0), max_n, known)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    counts = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _by_bucket(counts: DataFrame, buckets: int) -> np.ndarray:
    total = np.zeros(buckets, np.int64)
    for row in counts.collect():  # one row a bucket at most
        total[row["bucket"]] = row["n"]
    return total


def bucket_gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Gain of every bucket from the counts of corpus and target."""
    buckets, all_s, all_t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(scale * math.log((float(t) + 1) * (all_s + buckets) / ((float(s) + 1) * (all_t + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _noise(doc_id, seed: str, scale: int) -> int:
    h = int(hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_n: int = 1,
                    seed: str = SEED, scale: int = SCALE) -> DataFrame:
    """``id, n_words, n_features, weight, score`` of every document."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(len(gains))
        for batch in batches:
            doc, bucket, words = batch_features(batch.column(1), max_n, known)
            weight = np.zeros(len(words), np.int64)
            np.add.at(weight, doc, gains[bucket])
            noise = np.array([_noise(i, seed, scale) for i in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words.astype(np.int64)), pa.array(np.bincount(doc, minlength=len(words)).astype(np.int64)),
                 pa.array(weight), pa.array(weight + noise)], names=["id", "n_words", "n_features", "weight", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score, f"id {kind}, n_words long, n_features long, weight long, score long")


def ranked(scored: DataFrame) -> DataFrame:
    """``scored`` with the ``place`` of every row by score, ties to the smaller
    id; ranges of rows are ranked apart and shifted by the rows before them."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    dealt = scored.repartitionByRange(*order).withColumn("range", F.spark_partition_id()).checkpoint()
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))  # as many rows as partitions
    before = sizes.select(F.col("range").alias("_r"), F.coalesce(
        F.sum("rows").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return (dealt.withColumn("place", inside).join(before, F.col("range") == F.col("_r"))
            .withColumn("place", F.col("place") + F.col("before")).drop("range", "_r", "before"))


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              target_text_col: str = "text", max_n: int = 1, buckets: int = BUCKETS, percent: int = PERCENT,
              min_words: int = MIN_WORDS, seed: str = SEED, scale: int = SCALE) -> DataFrame:
    """``id, n_features, weight, score, rank`` of every document; those that
    are not drawn have no rank."""
    checkpoint_dir(docs.sparkSession)
    gains = bucket_gains(_by_bucket(bucket_counts(docs, text_col, max_n, buckets), buckets),
                         _by_bucket(bucket_counts(target, target_text_col, max_n, buckets), buckets), scale)
    scored = score_documents(docs, gains, id_col, text_col, max_n, seed, scale).checkpoint()
    fit = F.col("n_words") >= min_words
    drawn = scored.where(fit).count() * percent // 100
    placed = ranked(scored.where(fit)).withColumn("rank", F.when(F.col("place") <= drawn, F.col("place")).cast("long")).drop("place")
    out = placed.unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
