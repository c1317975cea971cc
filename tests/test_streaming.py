"""Streams over several files (one per micro-batch) against the batch jobs."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from clickwave.operators import cap_clicks, expand_runs, passed_clicks
from clickwave.plans import ads, hot_items, marketing, traffic
from clickwave.sources.text import read_ad_clicks, read_user_behavior
from clickwave.streaming import jobs
from clickwave.streaming.sinks import (
    LateSplitWriter, PageRankingWriter, RunningUvWriter, SlidingWindowWriter, SqlTopNWriter, TopNWriter, start_query,
)
from clickwave.streaming.sources import ad_click_stream, user_behavior_stream, web_log_stream
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")


def _write_files(folder, lines, n_files):
    os.makedirs(folder, exist_ok=True)
    per = -(-len(lines) // n_files)
    for i in range(n_files):
        p = f"{folder}/part-{i:04d}.csv"
        with open(p, "w") as f:
            f.write("".join(l + "\n" for l in lines[i * per:(i + 1) * per]))
        os.utime(p, (1_000_000_000 + i * 10, 1_000_000_000 + i * 10))  # file streams go by mtime


@pytest.fixture(scope="module")
def behavior_dir(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").orderBy("event_id").collect()
    lines = []
    for r in ev:
        k = int(r.props.split(":")[1].strip(" }"))
        beh = "pv" if r.event_type == "view" else r.event_type
        secs = int(r.ts.replace(tzinfo=dt.timezone.utc).timestamp())
        lines.append(f"{r.user_id},{k},{k % 7},{beh},{secs}")
    d = tempfile.mkdtemp(prefix="clickwave-ub-")
    _write_files(d, lines, 6)
    # a last page view two days ahead closes every window of the real rows
    last = max(int(l.rsplit(",", 1)[1]) for l in lines) + 2 * 86400
    p = f"{d}/part-9999.csv"
    with open(p, "w") as f:
        f.write(f"0,{CLOSER},0,pv,{last}\n")
    os.utime(p, (1_000_000_500, 1_000_000_500))
    return d


def _closed(df, wm):
    return df.where(F.col("window_end") <= F.lit(wm))


def _rows(df, *cols):
    return sorted(tuple(x) for x in df.select(*cols).collect())


def _run(df, mode="append"):
    q = start_query(df, "t", mode, sink="memory", trigger={"availableNow": True})
    q.awaitTermination(300)
    name = q.name
    return df.sparkSession.sql(f"select * from {name}")


CLOSER = 999_999


def _max_ts(batch):
    """Largest event time of the real rows (the closing row excluded)."""
    if "itemId" in batch.columns:
        batch = batch.where(F.col("itemId") != CLOSER)
    return batch.agg(F.max("ts")).collect()[0][0]


def test_hot_items_stream_equals_batch(spark, behavior_dir, tmpdir_fresh):
    batch = read_user_behavior(spark, behavior_dir)
    wm = _max_ts(batch)
    writer = TopNWriter(spark, tmpdir_fresh, "window_end", "itemId", "cnt", 5)
    q = start_query(jobs.hot_item_counts_stream(user_behavior_stream(spark, behavior_dir)), "items",
                    "append", foreach_batch=writer)
    q.awaitTermination(300)
    got = writer.result().select(F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                                 "itemId", "cnt", "rank")
    exp = _closed(hot_items.hot_items(batch), wm)
    assert got.count() > 0
    assert _rows(got, "window_end", "itemId", "cnt", "rank") == _rows(exp, "window_end", "itemId", "cnt", "rank")


def test_ranked_pane_writer_equals_batch(spark, behavior_dir, tmpdir_fresh):
    batch = read_user_behavior(spark, behavior_dir)
    wm = _max_ts(batch)
    writer = SlidingWindowWriter(spark, tmpdir_fresh, ["itemId"], "1 hour", "5 minutes", top=5)
    q = start_query(jobs.item_view_pane_updates(user_behavior_stream(spark, behavior_dir)), "ranked",
                    "update", foreach_batch=writer)
    q.awaitTermination(300)
    got = writer.result().select(F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                                 "itemId", "cnt", "rank")
    exp = _closed(hot_items.hot_items(batch), wm)
    assert _rows(got, "window_end", "itemId", "cnt", "rank") == _rows(exp, "window_end", "itemId", "cnt", "rank")


def test_sql_view_on_stream(spark, behavior_dir, tmpdir_fresh):
    batch = read_user_behavior(spark, behavior_dir)
    wm = _max_ts(batch)
    writer = SqlTopNWriter(spark, tmpdir_fresh, top=5)
    q = start_query(jobs.hot_items_sql_stream(spark, user_behavior_stream(spark, behavior_dir)), "sqlv",
                    "append", foreach_batch=writer)
    q.awaitTermination(300)
    got = writer.result().select("itemId", "cnt", F.col("windowEnd").cast("timestamp_ntz").alias("w"), "row_num")
    exp = hot_items.hot_items_sql(spark, batch).where(F.col("windowEnd") <= F.lit(wm))
    assert _rows(got, "itemId", "cnt", "w", "row_num") == _rows(exp, "itemId", "cnt", "windowEnd", "row_num")


def test_pv_and_uv_streams_equal_batch(spark, behavior_dir):
    batch = read_user_behavior(spark, behavior_dir)
    wm = _max_ts(batch)
    pv = _run(jobs.page_views_stream(user_behavior_stream(spark, behavior_dir)))
    pv = pv.select("key", F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt")
    assert _rows(pv, "key", "window_end", "cnt") == _rows(_closed(traffic.page_views(batch), wm), "key", "window_end", "cnt")
    uv = _run(jobs.unique_visitors_stream(user_behavior_stream(spark, behavior_dir)))
    uv = uv.select("key", F.col("window_end").cast("timestamp_ntz").alias("window_end"), "uv")
    assert _rows(uv, "key", "window_end", "uv") == \
        _rows(_closed(traffic.unique_visitors(batch), wm), "key", "window_end", "uv")


def test_running_uv_stream_equals_batch(spark, behavior_dir, tmpdir_fresh):
    batch = read_user_behavior(spark, behavior_dir).withColumn("offset", F.lit(0).cast("bigint"))
    views = jobs.bitmap_views_stream(user_behavior_stream(spark, behavior_dir))
    writer = RunningUvWriter(spark, tmpdir_fresh)
    q = start_query(views, "uvrun", "append", foreach_batch=writer)
    q.awaitTermination(300)
    got = writer.result().select(F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                                 F.col("ts").cast("timestamp_ntz").alias("ts"), "uv_count")
    exp = traffic.unique_visitors_running(batch)
    assert got.count() == exp.count()
    assert _rows(got, "window_end", "ts", "uv_count") == _rows(exp, "window_end", "ts", "uv_count")
    counts = writer.uv_count().select(F.col("window_end").cast("timestamp_ntz").alias("window_end"), "uv")
    assert _rows(counts, "window_end", "uv") == _rows(traffic.unique_visitors(batch), "window_end", "uv")


def test_marketing_windows_in_state_equal_batch(spark, behavior_dir):
    batch = read_user_behavior(spark, behavior_dir).select(
        "userId", "behavior", F.lit("c").alias("channel"), "ts")
    wm = _max_ts(batch)
    stream = user_behavior_stream(spark, behavior_dir).select("userId", "behavior", F.lit("c").alias("channel"), "ts")
    got = _run(jobs.marketing_stream(stream, by_channel=False, size="10 minutes", slide="30 seconds",
                                     uninstall="cart"))
    got = got.select(F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt")
    exp = _closed(marketing.total(batch, "cart", "10 minutes", "30 seconds"), wm)
    assert got.count() > 100
    assert _rows(got, "window_end", "cnt") == _rows(exp, "window_end", "cnt")


def test_sliding_window_writer_equals_batch(spark, behavior_dir, tmpdir_fresh):
    batch = read_user_behavior(spark, behavior_dir).select(
        "userId", "behavior", F.col("categoryId").cast("string").alias("channel"), "ts")
    wm = _max_ts(batch)
    stream = user_behavior_stream(spark, behavior_dir).select(
        "userId", "behavior", F.col("categoryId").cast("string").alias("channel"), "ts")
    writer = SlidingWindowWriter(spark, tmpdir_fresh, ["channel", "behavior"], "10 minutes", "30 seconds")
    q = start_query(jobs.marketing_pane_updates(stream, size="10 minutes", slide="30 seconds", uninstall="cart"), "panes",
                    "update", foreach_batch=writer)
    q.awaitTermination(300)
    got = writer.result().select("channel", "behavior",
                                 F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt")
    exp = _closed(marketing.by_channel(batch, "cart", "10 minutes", "30 seconds"), wm)
    assert got.count() > 100
    assert _rows(got, "channel", "behavior", "window_end", "cnt") == \
        _rows(exp, "channel", "behavior", "window_end", "cnt")
    # the same as runs, split where micro-batches meet
    runs_writer = SlidingWindowWriter(spark, tmpdir_fresh + "/runs", ["channel", "behavior"], "10 minutes",
                                      "30 seconds", output="runs")
    q = start_query(jobs.marketing_pane_updates(stream, size="10 minutes", slide="30 seconds", uninstall="cart"), "runs",
                    "update", foreach_batch=runs_writer)
    q.awaitTermination(300)
    dense = expand_runs(runs_writer.result(), "30 seconds").select(
        "channel", "behavior", F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt")
    assert _rows(dense, "channel", "behavior", "window_end", "cnt") == \
        _rows(exp, "channel", "behavior", "window_end", "cnt")


@pytest.fixture(scope="module")
def click_dir():
    # (user, ad, province, city, epoch s): user 1 clicks ad 7 five times on one UTC+8 day,
    # twice more after 16:00 UTC (next day there); user 2 clicks three times
    base = int(dt.datetime(2024, 1, 1, 15, 0, tzinfo=dt.timezone.utc).timestamp())
    rows = [(1, 7, "p1", base + i * 60) for i in range(5)] + \
           [(2, 7, "p2", base + 30 + i * 60) for i in range(3)] + \
           [(1, 7, "p1", base + 3600 + 10), (1, 7, "p1", base + 3600 + 20), (1, 7, "p1", base + 3600 + 30),
            (2, 8, "p2", base + 7 * 3600)]
    rows.sort(key=lambda r: r[3])
    lines = [f"{u},{a},{p},c,{t}" for u, a, p, t in rows]
    d = tempfile.mkdtemp(prefix="clickwave-ads-")
    _write_files(d, lines, 4)
    return d


@pytest.mark.parametrize("form", ["rows", "pandas"])
def test_click_cap_stream_matches_batch(spark, click_dir, form):
    batch = read_ad_clicks(spark, click_dir)
    tagged = jobs.capped_click_stream(ad_click_stream(spark, click_dir), cap=2, form=form)
    q = start_query(tagged, "cap", "append", sink="memory")
    q.awaitTermination(300)
    got = spark.sql(f"select * from {q.name}")
    exp = cap_clicks(batch, ["userId", "adId"], 2)
    assert _rows(got.where("kind = 'ok'"), "userId", "adId", F.col("ts").cast("timestamp_ntz")) == \
        _rows(passed_clicks(exp), "userId", "adId", "ts")
    alerts = _rows(got.where("kind = 'alert'"), "userId", F.col("ts").cast("timestamp_ntz"))
    assert alerts == _rows(exp.where("kind = 'alert'"), "userId", "ts")
    assert len(alerts) == 3  # user 1 on both days, user 2 once


def test_ads_by_province_stream(spark, click_dir):
    batch = read_ad_clicks(spark, click_dir)
    wm = _max_ts(batch)
    tagged = jobs.capped_click_stream(ad_click_stream(spark, click_dir), cap=2, delay="0 seconds")
    got = _run(jobs.ads_by_province_stream(tagged))
    got = got.select("province", F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt")
    exp = _closed(ads.by_province(batch, cap=2), wm)
    assert got.count() > 0
    assert _rows(got, "province", "window_end", "cnt") == _rows(exp, "province", "window_end", "cnt")


def test_hot_pages_revisions(spark, tmpdir_fresh):
    def line(t, url):
        return f"1.1.1.1 u - {t:%d/%m/%Y:%H:%M:%S} +0000 GET {url}"
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    s = dt.timedelta(seconds=1)
    lines = [
        [line(t0, "/a"), line(t0 + 2 * s, "/b"), line(t0 + 3 * s, "/b")],
        [line(t0 + 20 * s, "/a"), line(t0 + 21 * s, "/a.css")],   # watermark -> 10:00:19
        [line(t0 + 4 * s, "/a"), line(t0 + 5 * s, "/a")],          # late, within one minute: revise
        [line(t0 + 300 * s, "/c")],                                 # watermark -> 10:04:59
        [line(t0 + 301 * s, "/c")],                                 # lets the watermark take effect
        [line(t0 + 1 * s, "/c")],                                   # past the lateness of its first windows only
    ]
    d = tempfile.mkdtemp(prefix="clickwave-log-")
    for i, batch_lines in enumerate(lines):
        p = f"{d}/f{i:03d}.log"
        open(p, "w").write("\n".join(batch_lines) + "\n")
        os.utime(p, (1_000_000_000 + i * 10,) * 2)
    counts = jobs.page_pane_updates(web_log_stream(spark, d))
    writer = PageRankingWriter(spark, tmpdir_fresh, top=3)
    q = start_query(counts, "pages", "update", foreach_batch=writer)
    q.awaitTermination(300)
    ranks = writer.rankings.read()
    w5 = dt.datetime(2024, 1, 1, 10, 0, 5)
    # window ending 10:00:05 was issued, then revised after the late rows
    issues = sorted((r.epoch, r.url, r.cnt, r.rank) for r in ranks.where(F.col("window_end") == F.lit(w5)).collect())
    first_epoch = issues[0][0]
    assert sorted((k, u, c) for e, u, c, k in issues if e == first_epoch) == [(1, "/b", 2), (2, "/a", 1)]
    later = [(u, c, k) for e, u, c, k in issues if e > first_epoch]
    assert ("/a", 2, 1) in later or ("/a", 3, 1) in later
    ch = writer.changes.read()
    assert ch.where((F.col("window_end") == F.lit(w5)) & (F.col("op") == "-")).count() > 0
    # nothing ever ranks the static resource
    assert ranks.where(F.col("url") == "/a.css").count() == 0
    # the row at 10:00:01 arrives under watermark 10:04:59: windows ending before
    # 10:04:00 are final by then and are not revised; later ones may count it
    early = ranks.where((F.col("url") == "/c") & (F.col("window_end") < F.lit(dt.datetime(2024, 1, 1, 10, 4, 0))))
    assert early.count() == 0
    revised = ranks.where((F.col("url") == "/c") & (F.col("window_end") < F.lit(dt.datetime(2024, 1, 1, 10, 5, 0))))
    assert revised.count() > 0


def test_late_split_stream_equals_batch(spark, tmpdir_fresh):
    from clickwave.operators import split_late
    from clickwave.sources.text import web_log_from_lines
    # page requests arriving out of order in two source partitions, over several files
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    arrivals = [(0, 0), (1, 5), (0, 700), (1, 30), (0, 40), (1, 900), (0, 100), (1, 60),
                (0, 1500), (0, 820), (1, 200), (1, 2000), (0, 1000), (1, 1300)]
    lines = []
    for i, (src, sec) in enumerate(arrivals):
        ts = t0 + dt.timedelta(seconds=sec)
        lines.append((f"10.0.0.{src} {src} - {ts:%d/%m/%Y:%H:%M:%S} +0000 GET /p/{i % 3}", src, i))
    d = tempfile.mkdtemp(prefix="clickwave-late-")
    for f in range(4):
        p = f"{d}/f{f:03d}.csv"
        with open(p, "w") as fh:
            for line, src, i in lines[f * 4:(f + 1) * 4]:
                fh.write(f"{line},{src},{i}\n")
        os.utime(p, (1_000_000_000 + f * 10,) * 2)
    schema = "value string, source bigint, offset bigint"
    def prepared(df):
        return web_log_from_lines(df, ntz=False).withColumn("arrival", F.timestamp_micros(F.col("offset") * 1_000_000))
    stream = prepared(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).csv(d))
    writer = LateSplitWriter(spark, tmpdir_fresh, rows_per_bucket=2)
    q = start_query(stream, "late", "append", foreach_batch=writer)
    q.awaitTermination(300)
    got = writer.result()
    batch = prepared(spark.read.schema(schema).csv(d)).where(F.col("method") == "GET")
    exp = split_late(batch, "source", "arrival", "offset", "ts", "10 minutes", "5 seconds", "1 minute", "1 second")
    assert _rows(got, "offset", "is_late") == _rows(exp, "offset", "is_late")
    assert _rows(got, "offset", "is_late").count((9, True)) == 1  # 10:13:40 after 10:25:00 in source 0
