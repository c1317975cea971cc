"""The mix against its contract and its SQL."""

import re
from collections import defaultdict

import duckdb

from clickwave.llm import mixing
from clickwave.llm.catalog import ORACLES
from tests.llm.fixtures import awkward, documents


def targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight, the excess over the capacities reshared until there is none."""
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: weights[k % 3] for k, n in enumerate(names)}
    full, left = set(), float(sum(sizes.values()))
    while True:
        free = [n for n in names if n not in full]
        share = {n: left * weight[n] / sum(weight[k] for k in free) for n in free}
        over = [n for n in free if share[n] > most * sizes[n]]
        if not over:
            return {**{n: most * sizes[n] for n in full}, **share}
        full |= set(over)
        left -= sum(most * sizes[n] for n in over)


def check(rows, got):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want = targets(sizes)
    assert sorted(((r.doc_id, r.source, r.size) for r in got), key=str) == sorted(((i, s, size(t)) for i, t, s in rows), key=str)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    return want, taken


def test_mix_meets_its_targets(spark):
    rows = [(k, "w " * (1 + k * 7919 % 50), "abc"[k % 3]) for k in range(3000)] + [(9000, "only one", None)]
    got = mixing.mix_sources(documents(spark, rows, clashing=True)).collect()
    want, taken = check(rows, got)
    assert all(abs(taken[s] - want[s]) <= 0.005 * want[s] for s in "abc")
    assert taken[None] == 6
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(documents(spark, rows)).collect()))


def test_awkward_rows(spark):
    check(awkward(), mixing.mix_sources(documents(spark, awkward(), clashing=True)).collect())


def test_empty_and_wordless_tables(spark):
    assert mixing.mix_sources(documents(spark, [])).count() == 0
    assert mixing.take_copies(documents(spark, [])).count() == 0
    assert {r.taken for r in mixing.mix_sources(documents(spark, [(1, None, None), (2, " ", "a")])).collect()} == {0}


def test_copies_follow_the_decisions(spark):
    df = documents(spark, [(k, "w " * (1 + k % 9), "ab"[k % 2]) for k in range(200)], clashing=True)
    decided = {r.doc_id: r.copies for r in mixing.mix_sources(df).collect() if r.copies}
    out = mixing.take_copies(df)
    assert out.columns == df.columns
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == decided


def test_inclusion_is_unequal_by_source_and_even_within(spark):
    """Over many seeds a document is taken as often as its source's rate says."""
    rows = [(k, "w", "ab"[k % 2]) for k in range(100)]
    df = documents(spark, rows).coalesce(1)
    taken = defaultdict(int)
    for seed in range(12):
        for r in mixing.mix_sources(df, seed=str(seed)).collect():
            taken[r.source] += r.taken
    assert abs(taken["a"] / 12 - 100 * 5 / 7) < 1.5 and abs(taken["b"] / 12 - 100 * 2 / 7) < 1.5


def test_inclusion_follows_the_odds_within_a_source(spark):
    """Over many seeds, documents are taken as often as their expected copies
    say: in proportion to the binary digits of their size, at most 3 times."""
    sizes = (4, 9, 20, 40)
    rows = [(k, "w " * sizes[k // 2 % 4], "ab"[k % 2]) for k in range(1200)]
    words = sum(sizes) * 150
    goal = targets({"a": words, "b": words})

    def expected(target):
        low, high = 0.0, 3.0
        for _ in range(60):
            mid = (low + high) / 2
            total = sum(min(3, mid * len(f"{n:b}")) * n * 150 for n in sizes)
            low, high = (mid, high) if total < target else (low, mid)
        return {n: min(3, low * len(f"{n:b}")) for n in sizes}
    want = {(s, n): e for s in "ab" for n, e in expected(goal[s]).items()}
    df, seeds = documents(spark, rows).coalesce(1), 8
    copies = defaultdict(int)
    for seed in range(seeds):
        for r in mixing.mix_sources(df, seed=str(seed)).collect():
            copies[r.source, r.size] += r.copies
            assert int(want[r.source, r.size] + 1e-9) <= r.copies <= int(want[r.source, r.size] + 1e-9) + 1
    # 1200 draws each: four deviations are 0.06, and a few short ones fill the gaps
    assert all(abs(copies[k] / (150 * seeds) - want[k]) < 0.08 for k in want)
    assert want["a", 40] >= 1.9 * want["a", 4] and want["b", 40] >= 1.9 * want["b", 4]


def test_sql(spark):
    df = documents(spark, awkward() + [(1000 + k, "w " * (1 + k % 40), "abcd"[k % 4]) for k in range(900)])
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(ORACLES["op10_mixing"]).fetchall()
    names = [d[0] for d in con.description]
    got = mixing.mix_sources(df).select(*names).collect()
    key = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    assert sorted(map(key, got), key=str) == sorted(map(key, want), key=str)
