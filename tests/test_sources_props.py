import datetime as dt
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickwave.operators import expand_runs, sliding_count_runs, sliding_counts
from clickwave.plans import marketing
from clickwave.sources.connectors import kafka_sink_options, kafka_source_options, socket_source_options
from clickwave.sources.text import split_rejects
from clickwave.streaming.sinks import start_query
from clickwave.streaming.sources import user_behavior_stream
from tests.helpers import behavior_df, sorted_rows


def test_connector_options():
    assert kafka_source_options("localhost:9092", "hotitems") == {
        "kafka.bootstrap.servers": "localhost:9092", "subscribe": "hotitems",
        "startingOffsets": "latest"}
    assert kafka_source_options("b:1", "t", "earliest", **{"kafka.group.id": "consumer"})["kafka.group.id"] == "consumer"
    assert kafka_sink_options("b:1", "t") == {"kafka.bootstrap.servers": "b:1", "topic": "t"}
    assert socket_source_options("localhost", 7777) == {"host": "localhost", "port": "7777"}


def test_marketing_keeps_null_behaviour(spark):
    rows = [(1, 1, b, "2024-01-01 10:00:00", i) for i, b in enumerate(["CLICK", "UNINSTALL", None, "INSTALL"])]
    df = behavior_df(spark, rows).select("userId", "behavior", F.lit("wechat").alias("channel"), "ts")
    runs = marketing.by_channel_runs(df, size="10 seconds", slide="5 seconds")
    got = sorted((r.behavior or "", r.cnt) for r in runs.collect())
    assert got == [("", 1), ("CLICK", 1), ("INSTALL", 1)]
    tot = marketing.total(df, size="10 seconds", slide="5 seconds").collect()
    assert {r.cnt for r in tot} == {3} and len(tot) == 2


def test_malformed_lines_in_a_stream(spark):
    d = tempfile.mkdtemp(prefix="clickwave-bad-")
    with open(f"{d}/a.csv", "w") as f:
        f.write("1,2,3,pv,1704103200\nnot,a,valid,line,x\n4,5,6,pv\n7,8,9,pv,1704103260\n")
    stream = user_behavior_stream(spark, d)
    ok, bad = split_rejects(stream, ["userId", "itemId", "behavior", "timestamp"])
    q1 = start_query(ok, "ok_rows", "append")
    q2 = start_query(bad, "bad_rows", "append")
    q1.awaitTermination(120)
    q2.awaitTermination(120)
    assert spark.sql(f"select count(*) from {q1.name}").collect()[0][0] == 2
    assert spark.sql(f"select count(*) from {q2.name}").collect()[0][0] == 2


_events = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 3 * 3600 - 1)), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=_events, shape=st.sampled_from([(600, 5), (3600, 300), (60, 60), (120, 30)]))
def test_window_forms_agree(spark, events, shape):
    size, slide = shape
    base = dt.datetime(2024, 1, 1)
    rows = [(k, 0, "pv", (base + dt.timedelta(seconds=t)).isoformat(sep=" "), i)
            for i, (k, t) in enumerate(events)]
    df = behavior_df(spark, rows)
    native = sorted_rows(sliding_counts(df, ["userId"], "ts", size, slide, method="native"),
                         "userId", "window_end", "cnt")
    assert sorted_rows(sliding_counts(df, ["userId"], "ts", size, slide), "userId", "window_end", "cnt") == native
    runs = sliding_count_runs(df, ["userId"], "ts", size, slide, bucket_seconds=900)
    assert sorted_rows(expand_runs(runs, slide), "userId", "window_end", "cnt") == native
