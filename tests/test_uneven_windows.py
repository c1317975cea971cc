"""Windows whose size is no multiple of the slide; sketches of sliding windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickwave.operators import sliding_counts, sliding_distinct_count, sliding_distinct_sketch
from tests.helpers import sorted_rows

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def views(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(3), rng.randrange(40), T0 + dt.timedelta(seconds=rng.randrange(9000))) for _ in range(400)]
    rows += [(1, 1, T0 + dt.timedelta(seconds=s)) for s in (0, 120, 239, 240, 600)] + [(1, 2, None)]
    return spark.createDataFrame(rows, "k long, user long, ts timestamp_ntz")


@pytest.mark.parametrize("size,slide", [("10 minutes", "4 minutes"), ("7 minutes", "3 minutes"), ("10 minutes", "5 minutes"),
                                        ("3 minutes", "7 minutes"), ("4 minutes", "4 minutes"), ("2 minutes", "6 minutes")])
@pytest.mark.parametrize("method", ["pane", "expand"])
def test_uneven_windows_equal_sparks_own(views, size, slide, method):
    want = views.groupBy("k", F.window("ts", size, slide).end.alias("window_end")).agg(F.count(F.lit(1)).alias("cnt")) \
        if slide == size or int(size.split()[0]) >= int(slide.split()[0]) else None
    got = sorted_rows(sliding_counts(views, ["k"], "ts", size, slide, method), "k", "window_end", "cnt")
    if want is None:  # Spark refuses gaps between windows
        s, step = (60 * int(x.split()[0]) for x in (size, slide))
        plain = {}
        for r in views.where("ts is not null").collect():
            at = int((r.ts - dt.datetime(1970, 1, 1)).total_seconds())
            end = at // step * step + s
            if end > at:
                key = (r.k, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=end))
                plain[key] = plain.get(key, 0) + 1
        assert got == sorted((*k, n) for k, n in plain.items())
    else:
        assert got == sorted_rows(want, "k", "window_end", "cnt")


def test_sketches_of_panes_merge(views):
    exact = sorted_rows(sliding_distinct_count(views, "ts", "10 minutes", "4 minutes", "user"), "window_end", "uv")
    plain = views.groupBy(F.window("ts", "10 minutes", "4 minutes").end.alias("window_end")).agg(F.count_distinct("user").alias("uv"))
    assert exact == sorted_rows(plain, "window_end", "uv")
    got = sorted_rows(sliding_distinct_sketch(views, "ts", "10 minutes", "4 minutes", "user"), "window_end", "uv")
    assert got == exact  # few values: the sketch still holds them all
