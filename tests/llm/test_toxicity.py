"""The field against enumeration, and held-out accuracy on the labelled documents."""

import itertools
import math
import os
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from clickwave.llm import toxicity
from tests.conftest import SF_MID
from tests.llm.fixtures import awkward, documents, prose


def by_enumeration(emission, start, move):
    """Marginals of the toxic state from all state sequences."""
    ot, to, tt = move
    total, toxic = 0.0, np.zeros(len(emission))
    for states in itertools.product((0, 1), repeat=len(emission)):
        w = start * states[0] + sum(e for e, s in zip(emission, states) if s)
        w += sum({(0, 1): ot, (1, 0): to, (1, 1): tt}.get(p, 0.0) for p in zip(states, states[1:]))
        total += math.exp(w)
        toxic += math.exp(w) * np.array(states)
    return toxic / total


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    docs = [rng.normal(0, 2, n) for n in (1, 5, 9, 2, 8)]
    first = np.concatenate([[True] + [False] * (len(d) - 1) for d in docs])
    move = np.array([-1.3, 0.4, 1.1])
    f, b = toxicity.odds(np.concatenate(docs), first, -0.7, move)
    p = f * b / (1 + f * b)
    assert np.allclose(p, np.concatenate([by_enumeration(d, -0.7, move) for d in docs]))


def test_blocks_do_not_change_a_long_chain():
    rng = np.random.default_rng(2)
    e, move = rng.normal(0, 2, 5000), np.array([-1.0, 0.5, 0.8])
    first = np.zeros(5000, bool)
    first[[0, 70, 71, 3000]] = True
    f, b = toxicity.odds(e, first, -0.2, move)
    r = 1.0
    for t in range(5000):
        x, odds = math.exp(e[t]), r
        r = x * math.exp(-0.2) if first[t] else x * (math.exp(-1.0) + odds * math.exp(0.8)) / (1 + odds * math.exp(0.5))
        assert math.isclose(r, f[t], rel_tol=1e-9)


@pytest.fixture(scope="module")
def field():
    rng = random.Random(1)
    toxic = [prose(rng, 40) + " " + rng.choice(["grobian", "grobianly", "lout", "louts"]) + " " + prose(rng, 40) for _ in range(60)]
    return toxicity.fit(toxic + [prose(rng, 80) for _ in range(200)], [True] * 60 + [False] * 200)


def test_spans_point_at_the_offending_words(field):
    text = "ab cd grobianhood LOUT ef " + prose(random.Random(7), 3000)
    (score, spans), = toxicity.tag([text], field)
    assert score > 0.5 and [text[a:b] for a, b, _ in spans] in (["grobianhood LOUT"], ["grobianhood", "LOUT"])
    assert toxicity.tag(["", None, "!!"], field) == [(0.0, [])] * 3
    assert toxicity.tag([text], None) == [(0.0, [])]


def test_nothing_to_learn():
    assert toxicity.fit(["a b", None], [False, False]) is None
    assert toxicity.fit([], []) is None


def labelled(docs, words):
    rng = random.Random(5)
    vocabulary = prose(rng, 500).split()
    return [(" ".join(rng.choices(vocabulary, k=words)) + (" grobian" if k % 4 == 0 else ""), k % 4 == 0)
            for k in range(docs)]


def test_fitting_keeps_neither_texts_nor_words():
    peaks = []
    for docs in (20, 100):
        texts, toxic = zip(*labelled(docs, 2000))
        tracemalloc.start()
        assert toxicity.fit(texts, toxic, steps=1)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert (peaks[1] - peaks[0]) / (80 * 2000) < 100  # bytes a token


def test_pieces_do_not_change_the_field(monkeypatch):
    rows = list(labelled(40, 60))
    fields = []
    for piece in (toxicity._PIECE, toxicity._BLOCK, 5 * toxicity._BLOCK):
        monkeypatch.setattr(toxicity, "_PIECE", piece)
        fields.append(toxicity.fit_rows(iter(rows), steps=8))
    assert len(fields[0].weights) > 1
    for f in fields[1:]:
        assert (f.weights, f.bias, f.start, tuple(f.move)) == (
            fields[0].weights, fields[0].bias, fields[0].start, tuple(fields[0].move))


def test_awkward_rows(spark, field):
    rows = awkward() + [(500, "you lout", "a")]
    got = toxicity.score_documents(documents(spark, rows, clashing=True), field).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _, _ in rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) == int(r.doc_id == 500)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    df = documents(spark, rows, clashing=True)
    kept = toxicity.without_toxic(df, field)
    assert kept.columns == df.columns and kept.count() == len(rows) - 1
    assert toxicity.score_documents(documents(spark, []), field).count() == 0


def test_training_never_reads_held_out_labels(spark):
    rng = random.Random(3)
    out = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5 == 0][:60]
    rows = [(i, prose(rng, 30) + " lout", "a") for i in out] + [(i + 5000, prose(rng, 30), "a") for i in range(100)]
    labels = spark.createDataFrame([(i, 1) for i in out] + [(i + 5000, 0) for i in range(100)], "doc_id long, toxic int")
    assert toxicity.train(documents(spark, rows), labels) is None


def test_ids_with_several_texts_give_one_model(spark):
    rng = random.Random(4)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5][:200]
    rows = [(i, prose(rng, 20) + (" lout" if i % 2 else ""), "a") for i in ids]
    rows += [(i, prose(rng, 25), "a") for i in ids] + [(i, None, "a") for i in ids[:20]] + rows[:30]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    models = []
    for parts in (1, 3, 7):
        rng.shuffle(rows)
        field = toxicity.train(documents(spark, rows).repartition(parts), labels)
        models.append((field.weights, field.bias, field.start, tuple(field.move)) if field else None)
    assert models[0] is not None and models[0] == models[1] == models[2]


@pytest.mark.skipif(not os.path.isdir(SF_MID), reason="driver tables not present")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    scored = toxicity.score_documents(docs, toxicity.train(docs, labels)).where("held_out")
    rows = scored.join(labels, "doc_id").select("predicted", "toxic").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.95 * len(rows)
    assert not any(r.predicted and not r.toxic for r in rows)
