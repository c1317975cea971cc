"""What near-duplicate removal writes to disk follows what is alike, not the number of partitions."""

import random

import pytest

from clickwave.llm import components, minhash_dedup
from tests.llm.fixtures import documents, prose


@pytest.fixture
def many_partitions(spark):
    """As on a cluster whose session deals out 64 partitions and never merges them."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("per_task, least", [(50_000, 8), (2, 1), (50_000, 1)])
def test_rounds_have_tasks_for_their_edges(many_partitions, monkeypatch, per_task, least):
    monkeypatch.setattr(components, "ROWS_PER_TASK", per_task)
    monkeypatch.setattr(components, "LEAST_TASKS", least)
    edges = [(k, k + 1) for k in range(10)] + [(50, 50 + k) for k in range(9)] + [(60, 58), (7, 7), (99, 99), (None, 4)]
    got = components.components(many_partitions.createDataFrame(edges, "a long, b long"))
    want = {(k, 0) for k in range(1, 11)} | {(50 + k, 50) for k in range(1, 9)} | {(60, 50)}
    rows = list(map(tuple, got.collect()))
    assert {r for r in rows if r[0] != r[1]} == want and len({n for n, _ in rows}) == len(rows)
    if per_task > 2:
        assert got.rdd.getNumPartitions() <= least


@pytest.mark.parametrize("small", [200_000, 1])
def test_texts_move_only_where_a_bucket_is_shared(spark, monkeypatch, small):
    rng = random.Random(3)
    rows = [(k, prose(rng, 60), "a") for k in range(200)]
    words = prose(rng, 200)
    rows += [(500, words, "a"), (501, words + " end", "a"), (502, "the " + words, "b"), (500, rows[7][1], "b"), (None, words, "a")]
    asked, small_side = [], minhash_dedup.small_side

    def watched(df, most):
        asked.append(df.count())
        return small_side(df, most)

    monkeypatch.setattr(minhash_dedup, "small_side", watched)
    monkeypatch.setattr(minhash_dedup, "SMALL_IDS", small)
    got = minhash_dedup.near_documents(documents(spark, rows)).where("doc_id >= 500").collect()
    assert asked == [3]
    # 500 has two texts, so all of its copies are linked with document 7
    assert sorted((r.doc_id, r.class_id, r.component_id, r.kept) for r in got) == [
        (500, 7, 7, False), (500, 500, 7, False), (501, 501, 7, False), (502, 502, 7, False)]
