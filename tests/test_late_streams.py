"""Streams over several files with late rows, against a per-event simulation;
tables stored as folders; rejects."""

import datetime as dt
import os
import tempfile

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickwave.operators import running_aggregate
from clickwave.plans import ads, hot_pages
from clickwave.plans.catalog import ORACLES, QUERIES
from clickwave.sources.events import read_table
from clickwave.sources.text import (
    AD_CLICK_REQUIRED, count_rejects, read_ad_clicks, read_user_behavior, split_rejects,
)
from clickwave.streaming import jobs
from clickwave.streaming.sinks import (
    PageRankingWriter, SlidingWindowWriter, SqlTopNWriter, TopNWriter, final_rankings, start_query,
)
from clickwave.streaming.sources import ad_click_stream, user_behavior_stream, web_log_stream
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
#: Seconds after T0 by file: in order, then 1 s, 30 s, 5 min and 15 min late, each
#: with a file between, as Spark takes up a watermark one micro-batch later.
FILES = [[0, 30, 700, 705], [1200, 1205], [1260], [1259, 1230, 960, 360], [1300], [400, 1100], [1310], [90_000], [90_001]]


def write(files, line):
    d = tempfile.mkdtemp(prefix="clickwave-late-")
    for k, secs in enumerate(files):
        path = f"{d}/f{k:03d}.csv"
        with open(path, "w") as f:
            f.writelines(line(T0 + dt.timedelta(seconds=s), s) + "\n" for s in secs)
        os.utime(path, (1_000_000_000 + 10 * k,) * 2)
    return d


def simulate(size, slide, lateness=0, out_of_orderness=0):
    """Window end (seconds after T0) -> count, every row in the windows open when it arrives."""
    counts, top = {}, None
    for secs in FILES:
        wm = None if top is None else top - out_of_orderness
        for s in secs:
            end = (s // slide + 1) * slide
            while end - size <= s:
                if wm is None or end + lateness > wm:
                    counts[end] = counts.get(end, 0) + 1
                end += slide
        top = max(secs + ([] if top is None else [top]))
    return {e: n for e, n in counts.items() if e <= 80_000}


def epoch(line_time):
    return int(line_time.replace(tzinfo=dt.timezone.utc).timestamp())


def by_end(rows, col="window_end"):
    got = {int((r[col] - T0).total_seconds()): r["cnt"] for r in rows}
    return {e: n for e, n in got.items() if e <= 80_000}


def run(df, mode, writer):
    q = start_query(df, "late", mode, foreach_batch=writer)
    q.awaitTermination(300)
    return writer


@pytest.fixture(scope="module")
def behavior_files():
    return write(FILES, lambda t, s: f"1,5,0,pv,{epoch(t)}")


def test_hot_items_forms_agree_on_late_rows(spark, behavior_files, tmpdir_fresh):
    want = simulate(3600, 300)
    items = run(jobs.hot_item_counts_stream(user_behavior_stream(spark, behavior_files)), "append",
                TopNWriter(spark, f"{tmpdir_fresh}/a", "window_end", "itemId", "cnt", 5))
    sql = run(jobs.hot_items_sql_stream(spark, user_behavior_stream(spark, behavior_files)), "append",
              SqlTopNWriter(spark, f"{tmpdir_fresh}/b"))
    panes = run(jobs.item_view_pane_updates(user_behavior_stream(spark, behavior_files)), "update",
                SlidingWindowWriter(spark, f"{tmpdir_fresh}/c", ["itemId"], "1 hour", "5 minutes", top=5))
    assert by_end(items.result().collect()) == want
    assert by_end(sql.result().collect(), "windowEnd") == want
    assert by_end(panes.result().collect()) == want


@pytest.mark.parametrize("output", ["dense", "runs"])
def test_marketing_counts_late_rows_in_open_windows(spark, behavior_files, tmpdir_fresh, output):
    from clickwave.operators import expand_runs
    stream = user_behavior_stream(spark, behavior_files).select("behavior", F.lit("c").alias("channel"), "ts")
    writer = run(jobs.marketing_pane_updates(stream, by_channel=False, size="10 minutes", slide="30 seconds"), "update",
                 SlidingWindowWriter(spark, tmpdir_fresh, [], "10 minutes", "30 seconds", output=output))
    got = writer.result() if output == "dense" else expand_runs(writer.result(), "30 seconds")
    assert by_end(got.collect()) == simulate(600, 30)


def test_province_counts_late_rows_in_open_windows(spark):
    d = write(FILES, lambda t, s: f"{s},7,p1,c,{epoch(t)}")
    tagged = jobs.capped_click_stream(ad_click_stream(spark, d), cap=100, delay="0 seconds")
    q = start_query(jobs.ads_by_province_stream(tagged.where("kind = 'ok'")), "prov", "append")
    q.awaitTermination(300)
    got = by_end(spark.sql(f"select * from {q.name}").collect())
    in_order = {e for e in simulate(3600, 300)}
    assert set(got) <= in_order and got


def test_hot_pages_revise_every_open_window(spark, tmpdir_fresh):
    d = write(FILES, lambda t, s: f"1.1.1.1 u - {t:%d/%m/%Y:%H:%M:%S} +0000 GET /a")
    writer = run(jobs.page_pane_updates(web_log_stream(spark, d)), "update", PageRankingWriter(spark, tmpdir_fresh, top=3))
    got = by_end(final_rankings(writer.rankings.read()).collect())
    # end - 1 ms + lateness against the largest event time - 1 s
    assert got == simulate(600, 5, lateness=60 - 0.001, out_of_orderness=1)


@pytest.mark.parametrize("form", ["rows", "pandas"])
def test_late_clicks_count_in_their_own_day(spark, form):
    """15:59 arriving after 16:01 (a new day at UTC+8) neither resets nor joins the new day's count."""
    minutes = [["15:58:00", "16:01:00", "16:02:00"], ["15:59:00", "16:03:00", "16:04:00"]]
    d = tempfile.mkdtemp(prefix="clickwave-cap-")
    for k, times in enumerate(minutes):
        with open(f"{d}/f{k}.csv", "w") as f:
            f.writelines(f"1,7,p,c,{epoch(dt.datetime.fromisoformat(f'2024-01-01 {t}'))}\n" for t in times)
        os.utime(f"{d}/f{k}.csv", (1_000_000_000 + 10 * k,) * 2)
    q = start_query(jobs.capped_click_stream(ad_click_stream(spark, d), cap=2, form=form), "cap", "append")
    q.awaitTermination(300)
    got = sorted((r.kind, f"{r.ts:%H:%M}") for r in spark.sql(f"select * from {q.name}").collect())
    batch = ads.capped(read_ad_clicks(spark, d), cap=2).collect()
    assert got == sorted((r.kind, f"{r.ts:%H:%M}") for r in batch)
    assert got == [("alert", "16:03"), ("ok", "15:58"), ("ok", "15:59"), ("ok", "16:01"), ("ok", "16:02")]


def test_clicks_within_the_delay_are_not_dropped(spark):
    d = write([[0], [1800], [1900], [40], [2000]], lambda t, s: f"{s},7,p,c,{epoch(t)}")
    q = start_query(jobs.capped_click_stream(ad_click_stream(spark, d), cap=2), "cap5", "append")
    q.awaitTermination(300)
    assert spark.sql(f"select * from {q.name}").count() == 5


def test_malformed_clicks_are_rejects(spark):
    d = tempfile.mkdtemp(prefix="clickwave-bad-")
    with open(f"{d}/f.csv", "w") as f:
        f.write(f"1,7,p,c,{epoch(T0)}\n2,7,p,c,notatime\n")
    q = start_query(jobs.capped_click_stream(ad_click_stream(spark, d), cap=2), "bad", "append")
    q.awaitTermination(300)
    assert [r.userId for r in spark.sql(f"select * from {q.name}").collect()] == [1]
    clicks = read_ad_clicks(spark, d)
    assert [r.userId for r in ads.passed(clicks, cap=2).collect()] == [1]
    good, bad = split_rejects(clicks, AD_CLICK_REQUIRED)
    assert (good.count(), bad.count()) == (1, 1)
    seen = Observation()
    count_rejects(clicks, AD_CLICK_REQUIRED, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rejects": 1}
    with pytest.raises(PySparkException, match="bad record"):
        read_ad_clicks(spark, d, strict=True).count()
    strict = start_query(read_ad_clicks(spark, d, streaming=True, strict=True), "strict", "append")
    with pytest.raises(PySparkException):
        strict.awaitTermination(300)
    with open(f"{d}/f.csv", "w") as f:
        f.write("1,5,0,pv,1\n")
    assert read_user_behavior(spark, d, strict=True).count() == 1


def test_every_log_row_moves_the_watermark(spark):
    rows = [("/a", "GET", 0), ("/x.css", "GET", 1800), ("/b", "GET", 1080), ("/c", "POST", 3600), ("/d", "GET", 2800)]
    log = spark.createDataFrame([(0, u, m, T0 + dt.timedelta(seconds=s), T0 + dt.timedelta(seconds=k), k)
                                 for k, (u, m, s) in enumerate(rows)],
                                "source long, url string, method string, ts timestamp_ntz, arrival timestamp_ntz, offset long")
    got = {r.url: (r.is_late, r.watermark) for r in hot_pages.late_rows(log, "source", "arrival", "offset").collect()}
    assert got == {"/a": (False, None), "/b": (True, T0 + dt.timedelta(seconds=1799)),
                   "/d": (True, T0 + dt.timedelta(seconds=3599))}


def test_one_row_long_ago_does_not_widen_the_buckets(spark):
    rows = [(1, T0 + dt.timedelta(seconds=7 * k), k) for k in range(5000)] + [(1, dt.datetime(1970, 1, 1), 9999)]
    df = spark.createDataFrame(rows, "g long, ts timestamp_ntz, id long")
    from clickwave.operators import scan
    sizes = df.groupBy(scan._bucket(df, "ts", None, 100)).count()
    assert sizes.agg(F.max("count")).first()[0] <= 200
    got = running_aggregate(df, ["g"], ["ts", "id"], "count", "n", rows_per_bucket=100).orderBy("n").collect()
    assert [r.id for r in got] == [9999, *range(5000)] and [r.n for r in got] == list(range(1, 5002))


@pytest.fixture(scope="module")
def folder(spark):
    d = tempfile.mkdtemp(prefix="clickwave-folder-")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(4).write.parquet(f"{d}/events.parquet")
    return d


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
@pytest.mark.parametrize("name", [n for n in QUERIES if n.endswith("_stream")])
def test_streams_read_tables_that_are_folders(spark, folder, name):
    got = entry.queries()[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    want = con.execute(ORACLES[name]).fetchall()
    columns = [c[0] for c in con.description]
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want))
    assert want or name == "ad_click_alerts_stream"  # too few clicks at this scale for an alert


def test_a_stream_without_files_is_an_error(spark):
    d = tempfile.mkdtemp(prefix="clickwave-none-")
    os.mkdir(f"{d}/events.parquet")
    with pytest.raises((FileNotFoundError, PySparkException)):
        read_table(spark, d, "events", streaming=True)
