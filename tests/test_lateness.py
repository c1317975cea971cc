from pyspark.sql import functions as F

from clickwave.operators import split_late
from tests.helpers import behavior_df


def _log(spark, rows):
    # (source, 'event time', 'arrival', offset)
    base = behavior_df(spark, [(s, 0, "GET", t, o) for s, t, _, o in rows])
    arr = behavior_df(spark, [(s, 0, "GET", a, o) for s, _, a, o in rows]).select("offset", F.col("ts").alias("arrival"))
    return base.select(F.col("userId").alias("source"), "ts", "offset").join(arr, "offset")


def test_late_only_when_every_window_is_past_lateness(spark):
    rows = [
        (0, "2024-01-01 10:00:00", "2024-01-01 10:00:00", 0),
        (0, "2024-01-01 10:30:00", "2024-01-01 10:30:00", 1),   # watermark -> 10:29:59
        # last window of 10:18:00 ends 10:28:00; closed for good at 10:28:59.999 <= 10:29:59 -> late
        (0, "2024-01-01 10:18:00", "2024-01-01 10:30:01", 2),
        # last window of 10:19:05 ends 10:29:05; 10:30:04.999 > 10:29:59 -> still counted
        (0, "2024-01-01 10:19:05", "2024-01-01 10:30:02", 3),
        # another source has its own watermark
        (1, "2024-01-01 10:18:00", "2024-01-01 10:30:03", 4),
    ]
    out = split_late(_log(spark, rows), "source", "arrival", "offset", "ts", "10 minutes", "5 seconds",
                     "1 minute", "1 second", bucket_seconds=60)
    late = {r.offset: r.is_late for r in out.collect()}
    assert late == {0: False, 1: False, 2: True, 3: False, 4: False}


def test_boundary_exactly_at_cleanup_time(spark):
    # last window end 10:28:00 -> cleanup 10:28:59.999; watermark 10:29:00 - 1 s = 10:28:59 -> not late
    rows = [(0, "2024-01-01 10:29:00", "2024-01-01 10:29:00", 0),
            (0, "2024-01-01 10:18:00", "2024-01-01 10:29:01", 1),
            (0, "2024-01-01 10:29:01", "2024-01-01 10:29:02", 2),
            (0, "2024-01-01 10:18:00", "2024-01-01 10:29:03", 3)]  # watermark 10:29:00 -> late
    out = split_late(_log(spark, rows), "source", "arrival", "offset", "ts", "10 minutes", "5 seconds",
                     "1 minute", "1 second")
    late = {r.offset: r.is_late for r in out.collect()}
    assert late == {0: False, 1: False, 2: False, 3: True}
