"""Event time is moved by every row; the end of a bounded stream; state of the
processors at its edges."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from clickwave.plans import hot_items, hot_pages, traffic
from clickwave.sources.text import read_user_behavior
from clickwave.streaming import bounded, jobs, processors
from clickwave.streaming.sinks import (
    PageRankingWriter, RunningUvWriter, SqlTopNWriter, TopNWriter, final_rankings, start_query,
)
from clickwave.streaming.sources import ad_click_stream, user_behavior_stream, web_log_stream
from tests.test_late_streams import T0, epoch, write

#: Views in the first minutes, then other rows only, up to five and a half hours on.
BUYS_MOVE_TIME = [["pv 60", "pv 120"], ["buy 18000"], ["buy 19800"], ["pv 300", "buy 19801"], ["buy 19802"]]


def behavior(files):
    named = [[int(x.split()[1]) for x in f] for f in files]
    kinds = {int(x.split()[1]): x.split()[0] for f in files for x in f}
    return write(named, lambda t, s: f"{s},5,0,{kinds[s]},{epoch(t)}")


def rows(spark, df, name, mode="append", **options):
    q = start_query(df, name, mode, **options)
    q.awaitTermination(300)
    return spark.sql(f"select * from {name}").collect() if not options else None


def after(r, col="window_end"):
    return int((r[col] - T0).total_seconds())


def test_rows_that_a_job_leaves_out_move_its_time(spark, tmpdir_fresh):
    d = behavior(BUYS_MOVE_TIME)
    stream = lambda: user_behavior_stream(spark, d)
    assert [(after(r), r.cnt) for r in rows(spark, jobs.page_views_stream(stream()), "pv_t")] == [(3600, 2)]  # not the late view
    assert [(after(r), r.uv) for r in rows(spark, jobs.unique_visitors_stream(stream()), "uv_t")] == [(3600, 2)]
    got = {after(r): r.cnt for r in rows(spark, jobs.hot_item_counts_stream(stream()), "items_t")}
    assert got == {e: 2 for e in range(300, 3601, 300)}
    writer = SqlTopNWriter(spark, tmpdir_fresh)
    rows(spark, jobs.hot_items_sql_stream(spark, stream()), "sql_t", foreach_batch=writer)
    assert {after(r, "windowEnd"): r.cnt for r in writer.result().collect()} == got
    events = stream().select("behavior", F.lit("c").alias("channel"), "ts")
    runs = rows(spark, jobs.sliding_runs_stream(events, [], F.col("behavior") == "pv", "1 hour", "5 minutes"), "runs_t")
    assert {e for r in runs for e in range(after(r, "window_end_from"), after(r, "window_end_until"), 300)} == set(got)


def test_clicks_beyond_the_cap_move_time(spark):
    d = write([[0, 1], [2, 20_000], [20_001], [20_002]], lambda t, s: f"1,7,p1,c,{epoch(t)}")
    tagged = jobs.capped_click_stream(ad_click_stream(spark, d), cap=1, delay="0 seconds")
    got = rows(spark, jobs.ads_by_province_stream(tagged), "ads_t")
    assert {after(r): r.cnt for r in got} == {e: 1 for e in range(300, 3601, 300)}


@pytest.mark.parametrize("files", [BUYS_MOVE_TIME[:1], BUYS_MOVE_TIME[:2], [["pv 60", "pv 4000"], ["pv 4100"], ["pv 9000", "buy 9001"]]])
def test_open_windows_at_the_end_are_those_that_batch_has(spark, tmpdir_fresh, files):
    d = behavior(files)
    batch = read_user_behavior(spark, d)
    writer = TopNWriter(spark, f"{tmpdir_fresh}/out", "window_end", "itemId", "cnt", 5)
    rows(spark, jobs.hot_item_counts_stream(user_behavior_stream(spark, d)), "end", checkpoint=f"{tmpdir_fresh}/ck", foreach_batch=writer)
    writer(bounded.open_counts(spark, f"{tmpdir_fresh}/ck", ["itemId", "window"]), 99)
    got = sorted((after(r), r.itemId, r.cnt) for r in writer.result().collect())
    assert got == sorted((after(r), r.itemId, r.cnt) for r in hot_items.hot_items(batch).collect())


def test_a_query_that_never_ran_has_no_state(spark, tmpdir_fresh):
    with pytest.raises(Exception):  # no checkpoint at all
        bounded.open_counts(spark, f"{tmpdir_fresh}/nothing", ["window"]).count()


@pytest.mark.parametrize("salts", [1, 3])
def test_pages_of_several_files_end_as_in_batch(spark, tmpdir_fresh, monkeypatch, salts):
    """Many pages a window, in order, with the pages of a block in the map as well."""
    rng = random.Random(8)
    urls = [f"/p{k}" for k in range(40)]
    files = [sorted(rng.randrange(900) + 900 * k for _ in range(60)) for k in range(4)]
    d = write(files, lambda t, s: f"1.1.1.1 u - {t:%d/%m/%Y:%H:%M:%S} +0000 GET {urls[s * s % 40]}")
    monkeypatch.setattr(processors.PageRankingProcessor, "FEW", 5)
    writer = PageRankingWriter(spark, f"{tmpdir_fresh}/out", top=3)
    rows(spark, jobs.page_pane_updates(web_log_stream(spark, d), salts=salts), "pages_t", "update",
         checkpoint=f"{tmpdir_fresh}/ck", foreach_batch=writer)
    writer(bounded.open_page_lists(spark, f"{tmpdir_fresh}/ck"), 99)
    got = sorted((after(r), r["rank"], r.url, r.cnt) for r in final_rankings(writer.rankings.read()).collect())
    from clickwave.sources.text import web_log_from_lines
    exp = hot_pages.hot_pages(web_log_from_lines(spark.read.text(d)))
    assert got == sorted((after(r), r["rank"], r.url, r.cnt) for r in exp.collect())
    kept = writer.changes.read().groupBy("window_end", "url", "cnt", "rank").agg(
        F.sum(F.when(F.col("op") == "+", 1).otherwise(-1)).alias("n")).where("n <> 0").collect()
    assert sorted((after(r), r["rank"], r.url, r.cnt) for r in kept) == got and {r.n for r in kept} == {1}


def test_running_visitors_over_files_with_a_full_bitmap(spark, tmpdir_fresh, monkeypatch):
    """Repeated visitors over several files, beyond the list of a window; rows late for their window."""
    monkeypatch.setattr(processors.NewVisitorProcessor, "FEW", 7)
    rng = random.Random(5)
    files = [sorted(rng.sample(range(1200 * k, 1200 * (k + 1)), 50)) for k in range(6)]
    d = write(files, lambda t, s: f"{s % 37},5,0,{'pv' if s % 3 else 'buy'},{epoch(t)}")
    writer = RunningUvWriter(spark, f"{tmpdir_fresh}/out")
    rows(spark, jobs.bitmap_views_stream(user_behavior_stream(spark, d)), "uv_bits", foreach_batch=writer)
    batch = read_user_behavior(spark, d)
    want = sorted((after(r), r.ts, r.uv_count) for r in traffic.unique_visitors_running(batch).collect())
    assert sorted((after(r), r.ts, r.uv_count) for r in writer.result().collect()) == want
    assert sorted((after(r), r.uv) for r in writer.uv_count().collect()) == sorted(
        (after(r), r.uv) for r in traffic.unique_visitors(batch).collect())


def test_steps_add_up():
    rng = random.Random(1)
    at, level, plain = [], [], {}
    for _ in range(60):
        ranges = [(a, a + rng.randint(1, 9), rng.randint(1, 4)) for a in (rng.randrange(50) for _ in range(3))]
        at, level = processors.add_steps(at, level, ranges)
        for a, b, c in ranges:
            for e in range(a, b):
                plain[e] = plain.get(e, 0) + c
        assert {e: n for k, n in enumerate(level[:-1]) for e in range(at[k], at[k + 1]) if n} == plain
        assert level[-1] == 0 and all(x != y for x, y in zip(level, level[1:]))


def test_a_hot_key_is_combined_in_the_map_tasks(spark):
    """A channel of a million rows reaches the processor as one row per pane and map task."""
    from clickwave.streaming.combine import combined
    df = spark.range(0, 1_000_000, 1, 4).select(F.lit("c").alias("channel"), (F.col("id") % 3).alias("pane_end"),
                                                 F.timestamp_seconds(F.col("id")).alias("ts"))
    parts = combined(df, ["channel", "pane_end"], "ts", F.col("pane_end") < 2).collect()
    assert len(parts) == 4 * 3 and sum(r.n for r in parts) == df.where("pane_end < 2").count()
    assert max(epoch(r.ts) for r in parts if r.channel is None) == 999_998  # left out, but it moves time
