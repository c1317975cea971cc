import datetime as dt

from pyspark.sql import functions as F

from clickwave.functions import (
    alert_message, java_timestamp_text, not_equal_keep_null, not_static_resource, polynomial_hash,
)
from clickwave.sources.text import (
    ad_clicks_from_lines, split_rejects, user_behavior_from_lines, web_log_from_lines,
)


def py_hash(value: str, seed: int = 61, cap: int = 1 << 29) -> int:
    result = 0
    for ch in value:
        result = (result * seed + ord(ch)) & 0xFFFFFFFFFFFFFFFF  # Java long wraps
    return result & (cap - 1)


def test_polynomial_hash_matches_long_arithmetic(spark):
    values = ["", "0", "7", "543462", "937166", "99999999999", "12345678901234567"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = dict(df.select("s", polynomial_hash(F.col("s")).alias("h")).collect())
    assert got == {v: py_hash(v) for v in values}


def test_user_behavior_lines_and_rejects(spark):
    lines = spark.createDataFrame([("543462,1715,1464116,pv,1511658000",),
                                   ("bad,1715,1,pv,1511658000",),
                                   ("1,2,3,pv",)], "value string")
    parsed = user_behavior_from_lines(lines)
    ok, bad = split_rejects(parsed, ["userId", "itemId", "behavior", "timestamp"])
    row = ok.collect()
    assert len(row) == 1 and row[0]["userId"] == 543462 and row[0]["behavior"] == "pv"
    assert row[0]["ts"] == dt.datetime(2017, 11, 26, 1, 0, 0)
    assert bad.count() == 2


def test_ad_click_line(spark):
    lines = spark.createDataFrame([("937166,1715,beijing,beijing,1511661701",)], "value string")
    r = ad_clicks_from_lines(lines).collect()[0]
    assert (r["userId"], r["adId"], r["province"], r["city"], r["timestamp"]) == \
        (937166, 1715, "beijing", "beijing", 1511661701)


def test_web_log_line(spark):
    lines = spark.createDataFrame(
        [("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash-monitorama-2013/images/kibana-search.png",),
         ("1.2.3.4 - - 32/13/2015:10:05:03 +0000 GET /x",)], "value string")
    rows = web_log_from_lines(lines).collect()
    assert rows[0]["ip"] == "83.149.9.216" and rows[0]["method"] == "GET"
    assert rows[0]["ts"] == dt.datetime(2015, 5, 17, 10, 5, 3)
    assert rows[0]["timestamp"] == 1431857103000
    assert rows[1]["ts"] is None  # unparsable time -> null, not a failed job


def test_static_resource_filter(spark):
    urls = {"/index.html": True, "/a.css": False, "/a.js": False, "/b.png": False, "/favicon.ico": False,
            "/a.CSS": True, "/a.js?y": True, "/x.css/y": True, "/": True}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = dict(df.select("url", not_static_resource("url").alias("k")).collect())
    assert got == urls


def test_not_equal_keeps_null(spark):
    df = spark.createDataFrame([("CLICK",), ("UNINSTALL",), (None,)], "b string")
    assert sorted(df.where(not_equal_keep_null("b", "UNINSTALL")).collect(), key=str) == \
        sorted(df.where("b is null or b = 'CLICK'").collect(), key=str)


def test_texts(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 11, 26, 9, 5),)], "t timestamp_ntz")
    r = df.select(java_timestamp_text(F.col("t")).alias("s"), alert_message(100).alias("m")).collect()[0]
    assert r["s"] == "2017-11-26 09:05:00.0"
    assert r["m"] == "click over100 times"


def test_window_ends_as_epoch_milliseconds(spark):
    import datetime as dt

    from clickwave.functions import epoch_millis
    df = spark.createDataFrame([(dt.datetime(2017, 11, 26, 1, 5),)], "w timestamp_ntz")
    assert df.select(epoch_millis(F.col("w"))).first()[0] == 1511658300000
