import datetime as dt

from pyspark.sql import functions as F

from clickwave.operators import (
    blacklist_alerts, cap_clicks, passed_clicks, ranking_reports, top_n_by_count,
)
from clickwave.plans import ads
from clickwave.sources.text import read_ad_clicks
from tests.helpers import behavior_df, sorted_rows


def test_ties_break_by_key_ascending(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 7), (4, 5), (5, 1)], "itemId long, cnt long") \
        .withColumn("window_end", F.lit("w"))
    top = top_n_by_count(df, "window_end", "itemId", "cnt", 3)
    assert sorted_rows(top, "rank", "itemId") == [(1, 2), (2, 3), (3, 1)]


def test_fewer_rows_than_n_and_report_text(spark):
    df = spark.createDataFrame([(7, 3, dt.datetime(2017, 11, 26, 9, 5))],
                               "itemId long, cnt long, window_end timestamp_ntz")
    top = top_n_by_count(df, "window_end", "itemId", "cnt", 5)
    rep = ranking_reports(top, "window_end", "itemId", "cnt").collect()[0]["report"]
    assert rep == ("=====================窗口结束时间：2017-11-26 09:05:00.0\n"
                   "NO 1: 商品ID=7热门度=3\n=====================\n\n")


def _clicks(spark, rows):
    # (userId, adId, 'YYYY-MM-DD HH:MM:SS', offset)
    base = behavior_df(spark, [(u, a, "pv", t, o) for u, a, t, o in rows])
    return base.select("userId", F.col("itemId").alias("adId"), F.lit("p").alias("province"), "ts", "offset")


def test_cap_n_and_n_plus_one(spark):
    rows = [(1, 9, f"2024-01-01 01:00:0{i}", i) for i in range(5)] + [(2, 9, "2024-01-01 01:00:00", 10)]
    capped = cap_clicks(_clicks(spark, rows), ["userId", "adId"], 3, order=["offset"])
    ok = passed_clicks(capped)
    assert sorted_rows(ok, "userId", "offset") == [(1, 0), (1, 1), (1, 2), (2, 10)]
    al = blacklist_alerts(capped, ["userId", "adId"], 3).collect()
    assert len(al) == 1 and al[0]["warning_msg"] == "click over3 times"
    assert al[0]["ts"].second == 3
    # exactly N clicks: no alert
    capped2 = cap_clicks(_clicks(spark, rows[:3]), ["userId", "adId"], 3, order=["offset"])
    assert blacklist_alerts(capped2, ["userId", "adId"], 3).count() == 0


def test_daily_reset_at_16_utc(spark):
    # 15:59 UTC is 23:59 at UTC+8; 16:00 UTC starts a new day there
    rows = [(1, 9, "2024-01-01 15:58:00", 0), (1, 9, "2024-01-01 15:59:00", 1),
            (1, 9, "2024-01-01 16:00:00", 2), (1, 9, "2024-01-01 16:01:00", 3)]
    capped = cap_clicks(_clicks(spark, rows), ["userId", "adId"], 1, order=["offset"])
    assert sorted_rows(passed_clicks(capped), "offset") == [(0,), (2,)]
    assert sorted_rows(blacklist_alerts(capped, ["userId", "adId"], 1), "ts") != []
    no_reset = cap_clicks(_clicks(spark, rows), ["userId", "adId"], 1, order=["offset"], daily_reset=False)
    assert sorted_rows(passed_clicks(no_reset), "offset") == [(0,)]


def test_the_cap_of_a_hundred_clicks(spark, tmpdir_fresh):
    """The job's real constants on a log of 143 clicks, one pair with 121 of them."""
    start = 1511658000  # 2017-11-26 01:00 UTC
    rows = [(1, 7, "beijing", start + 30 * k) for k in range(121)]
    rows += [(100 + k, 8, ("jiangsu", "zhejiang", "henan")[k % 3], start + 120 * k) for k in range(22)]
    with open(f"{tmpdir_fresh}/clicks.csv", "w") as f:
        f.writelines(f"{u},{a},{p},city,{t}\n" for u, a, p, t in sorted(rows, key=lambda r: r[3]))
    clicks = read_ad_clicks(spark, tmpdir_fresh)
    assert clicks.count() == 143
    assert ads.passed(clicks).count() == 122
    (alert,) = ads.alerts(clicks).collect()
    assert (alert.userId, alert.adId, alert.warning_msg) == (1, 7, "click over100 times")
    assert int((alert.ts - dt.datetime(1970, 1, 1)).total_seconds()) == start + 30 * 100
    counts = {(r.province, r.window_end): r.cnt for r in ads.by_province(clicks).collect()}
    assert counts["beijing", dt.datetime(2017, 11, 26, 2, 0)] == 100
    assert counts["jiangsu", dt.datetime(2017, 11, 26, 2, 0)] == 8
    assert max(n for (p, _), n in counts.items() if p == "beijing") == 100


def test_a_bot_never_holds_more_clicks_than_the_cap_lets_pass():
    import gc
    import weakref

    from clickwave.streaming.processors import ClickCapRowProcessor

    class Click(dict):
        alive = weakref.WeakSet()

        def __init__(self, **fields):
            super().__init__(fields)
            self.alive.add(self)

        __hash__ = object.__hash__
        asDict = dict.copy

    class Value:
        now = None

        def get(self):
            return self.now

        def update(self, value):
            self.now = value

    class Handle:
        timers = []

        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, at):
            self.timers.append(at)

    cap, most = 10, []

    def clicks(times):
        for t in times:
            yield Click(ts=t, offset=t, _day_end=10**6)
            most.append(len(Click.alive))

    proc = ClickCapRowProcessor(cap)
    proc.init(Handle())
    gc.collect()
    first = list(proc.handleInputRows(None, clicks(range(104, 100, -1)), None))
    assert [(r.ts, r.kind) for r in first] == [(t, "ok") for t in range(101, 105)]
    second = list(proc.handleInputRows(None, clicks(range(5000, 1000, -1)), None))
    assert [(r.ts, r.kind) for r in second] == [(t, "ok") for t in range(1001, 1007)] + [(1007, "alert")]
    assert not list(proc.handleInputRows(None, clicks(range(6000, 9000)), None))
    assert Handle.timers == [10**6] and max(most) <= cap + 3
