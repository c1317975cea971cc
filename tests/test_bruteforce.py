"""Operators against per-event Python simulations of the reference's algorithms."""

import datetime as dt
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from clickwave.operators import (
    bitmap_distinct_count, cap_clicks, distinct_count, passed_clicks, running_distinct_count,
    sliding_counts, top_n_by_count,
)
from tests.helpers import behavior_df, sorted_rows

BASE = dt.datetime(2024, 1, 1, 12, 0, 0)


def py_hash(value: str, seed: int = 61, cap: int = 1 << 29) -> int:
    h = 0
    for ch in value:
        h = (h * seed + ord(ch)) & 0xFFFFFFFFFFFFFFFF
    return h & (cap - 1)


def _events(n, seed, users=6, items=5, span_s=8 * 3600):
    rnd = random.Random(seed)
    rows = sorted((rnd.randrange(span_s), rnd.randrange(users), rnd.randrange(items)) for _ in range(n))
    return [(u, i, "pv", (BASE + dt.timedelta(seconds=t)).isoformat(sep=" "), k)
            for k, (t, u, i) in enumerate(rows)]


def test_cap_matches_per_event_filter(spark):
    rows = _events(300, seed=5, users=3, items=2, span_s=3 * 86400)
    cap = 4
    # per event, in arrival order: count per (user, ad), reset when the UTC+8 day changes
    state, passed, alerts = {}, [], []
    for u, a, _, t, k in rows:
        day = (dt.datetime.fromisoformat(t) + dt.timedelta(hours=8)).date()
        cnt, sent, d = state.get((u, a), (0, False, day))
        if d != day:
            cnt, sent = 0, False
        if cnt >= cap:
            if not sent:
                alerts.append(k)
                sent = True
        else:
            cnt += 1
            passed.append(k)
        state[(u, a)] = (cnt, sent, day)
    df = behavior_df(spark, rows).select("userId", F.col("itemId").alias("adId"), "ts", "offset")
    capped = cap_clicks(df, ["userId", "adId"], cap, order=["offset"])
    assert sorted(r.offset for r in passed_clicks(capped).collect()) == sorted(passed)
    assert sorted(r.offset for r in capped.where("kind = 'alert'").collect()) == sorted(alerts)


def test_top_n_matches_sorted_window_lists(spark):
    rows = _events(250, seed=9, items=12)
    size, slide, n = 3600, 300, 3
    counts = defaultdict(Counter)
    for _, item, _, t, _ in rows:
        s = int((dt.datetime.fromisoformat(t) - dt.datetime(1970, 1, 1)).total_seconds())
        first_end = (s // slide) * slide + slide
        for e in range(first_end, first_end + size, slide):
            counts[e][item] += 1
    expect = []
    for e, c in counts.items():
        ranked = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
        expect += [(dt.datetime(1970, 1, 1) + dt.timedelta(seconds=e), item, cnt, r + 1)
                   for r, (item, cnt) in enumerate(ranked)]
    df = behavior_df(spark, rows)
    got = top_n_by_count(sliding_counts(df, ["itemId"], "ts", size, slide), "window_end", "itemId", "cnt", n)
    assert sorted_rows(got, "window_end", "itemId", "cnt", "rank") == sorted(expect)


def test_running_uv_matches_bitmap_process(spark):
    rows = _events(200, seed=13, users=25)
    bits, count, expect = defaultdict(set), Counter(), []
    for u, _, _, t, k in rows:               # rows are in arrival order
        ts = dt.datetime.fromisoformat(t)
        end = ts.replace(minute=0, second=0) + dt.timedelta(hours=1)
        off = py_hash(str(u))
        if off not in bits[end]:
            bits[end].add(off)
            count[end] += 1
            expect.append((end, ts, count[end]))
    df = behavior_df(spark, rows)
    # 10-minute buckets: each hour's ranking spans six buckets
    got = running_distinct_count(df, "ts", "1 hour", "userId", bucket_seconds=600)
    assert sorted_rows(got, "window_end", "ts", "uv_count") == sorted(expect)


def _colliding_ids():
    seen = {}
    rnd = random.Random(1)
    while True:
        v = rnd.randrange(10 ** 15, 10 ** 16)
        h = py_hash(str(v))
        if h in seen and seen[h] != v:
            return seen[h], v
        seen[h] = v


def test_bitmap_counts_a_collision_once(spark):
    a, b = _colliding_ids()
    rows = [(a, 1, "pv", "2024-01-01 10:00:00", 0), (b, 1, "pv", "2024-01-01 10:10:00", 1),
            (7, 1, "pv", "2024-01-01 10:20:00", 2)]
    df = behavior_df(spark, rows)
    assert bitmap_distinct_count(df, "ts", "1 hour", "userId").collect()[0]["uv"] == 2
    assert distinct_count(df, "ts", "1 hour", "userId").collect()[0]["uv"] == 3
