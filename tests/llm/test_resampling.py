"""Importance resampling against a plain count, word by word."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from clickwave.llm import importance_resampling as ir
from tests.llm.fixtures import awkward, documents, prose

ODD = [(801, "ÀÉ Straße İstanbul 漢字かな 🙂🙂 a_b-c'd 007\x00x\x7fy K Z[z]", "a"), (802, "A" * 300 + " ", "b"),
       (803, "\x00\x00", "a"), (804, " ".join(["same"] * 19), "a"), (805, " ".join(["same"] * 20), "a"),
       (805, " ".join(["same"] * 20), "a")]


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text, max_n):
    words = words_of(text)
    return [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, max_n=1, buckets=10_000, percent=10, min_words=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, max_n))
    t = Counter(bucket(f) for x in target for f in features(x, max_n))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for i, text in rows:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        mine = features(text, max_n)
        weight = sum(gain(bucket(f)) for f in mine)
        out.append([i, len(mine), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [k for k, (_, text) in enumerate(rows) if len(words_of(text)) >= min_words]
    for rank, k in enumerate(sorted(able, key=lambda k: (-out[k][3], out[k][0] is None, out[k][0]))[:len(able) * percent // 100]):
        out[k][4] = rank + 1
    return Counter(map(tuple, out))


def table(rows):
    return [(i, t) for i, t, _ in rows]


@pytest.mark.parametrize("options", [{}, {"max_n": 3, "buckets": 50, "percent": 60, "min_words": 2}])
def test_matches_a_plain_count(spark, options):
    rng = random.Random(6)
    rows = awkward() + ODD + [(i + 1, t, s) for i, t, s in awkward()[11:40]]
    target = [prose(rng, 40) for _ in range(30)] + [None, "", "Straße 007 same same"]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    docs = documents(spark, rows, clashing=True).repartition(5)
    got = ir.resampled(docs, bench, **options).collect()
    assert Counter(map(tuple, got)) == plain(table(rows), target, **options)
    again = ir.resampled(docs.repartition(3), bench, **options).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_ngrams_do_not_cross_documents():
    doc, bucket, words = ir.batch_features(pa.array(["a b", "c", None, "", "d e f"]), 2, ir.Buckets(1 << 31))
    want = [(0, "a"), (0, "b"), (1, "c"), (4, "d"), (4, "e"), (4, "f"), (0, "a b"), (4, "d e"), (4, "e f")]
    assert list(zip(doc, bucket)) == [(d, zlib.crc32(f.encode()) % (1 << 31)) for d, f in want]
    assert words.tolist() == [2, 1, 0, 0, 3]


def test_ties_and_equal_scores_are_ranked_across_ranges(spark):
    rows = spark.range(0, 3000, 1, 7).selectExpr("id", "id % 3 as score")
    got = ir.ranked(rows).collect()
    want = sorted(got, key=lambda r: (-r.score, r.id))
    assert [r.place for r in want] == list(range(1, 3001))


def test_remembered_features_are_bounded(monkeypatch):
    monkeypatch.setattr(ir, "_REMEMBERED", 10)
    known = ir.Buckets(1000)
    for k in range(50):
        found = [f"{k} {j}".encode() for j in range(7)]
        assert known.of(found).tolist() == [zlib.crc32(f) % 1000 for f in found] and len(known) <= 17


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert ir.resampled(documents(spark, []), none).count() == 0
    rows = [(k, "w " * 30, "a") for k in range(20)]
    assert Counter(map(tuple, ir.resampled(documents(spark, rows), none).collect())) == plain(table(rows), [])
    null = spark.createDataFrame([(None, None)] * 3, "doc_id long, text string")
    assert Counter(map(tuple, ir.resampled(null, none).collect())) == plain([(None, None)] * 3, [])
