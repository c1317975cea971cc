import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickwave.operators import running_aggregate
from tests.helpers import behavior_df, sorted_rows


def _df(spark, n=500):
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        t = rnd.randrange(3 * 3600)
        rows.append((rnd.randrange(3), rnd.randrange(50), "pv",
                     f"2024-01-01 {t // 3600:02d}:{t // 60 % 60:02d}:{t % 60:02d}", i))
    return behavior_df(spark, rows)


def test_running_count_sum_max_match_window_functions(spark):
    df = _df(spark)
    w = Window.partitionBy("userId").orderBy("ts", "offset")
    expect = df.select(
        "offset",
        F.row_number().over(w).cast("bigint").alias("n"),
        F.sum("itemId").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.max("itemId").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("m"),
        F.lead("offset").over(w).alias("nx"),
    )
    # 5-minute buckets: every group spans ~36 buckets, so carries are exercised
    got_n = running_aggregate(df, ["userId"], ["ts", "offset"], "count", "n", bucket_seconds=300)
    got_s = running_aggregate(df, ["userId"], ["ts", "offset"], "sum", "s", value="itemId", bucket_seconds=300)
    got_m = running_aggregate(df, ["userId"], ["ts", "offset"], "max", "m", value="itemId",
                              inclusive=False, bucket_seconds=300)
    got = (got_n.select("offset", "n").join(got_s.select("offset", "s"), "offset")
           .join(got_m.select("offset", "m"), "offset"))
    assert sorted_rows(got, "offset", "n", "s", "m") == sorted_rows(expect, "offset", "n", "s", "m")


def test_next_value_crosses_buckets(spark):
    df = _df(spark, 200)
    w = Window.partitionBy("userId").orderBy("ts", "offset")
    expect = df.select("offset", F.lead("ts").over(w).alias("nx"))
    got = running_aggregate(df, ["userId"], ["ts", "offset"], "count", "n", next_of="ts",
                            next_out="nx", bucket_seconds=120)
    assert sorted_rows(got, "offset", "nx") == sorted_rows(expect, "offset", "nx")


def test_null_group_key(spark):
    df = _df(spark, 100).withColumn("g", F.when(F.col("userId") == 0, None).otherwise(F.col("userId")))
    got = running_aggregate(df, ["g"], ["ts", "offset"], "count", "n", bucket_seconds=600)
    assert got.count() == 100
    w = Window.partitionBy("g").orderBy("ts", "offset")
    expect = df.select("offset", F.row_number().over(w).cast("bigint").alias("n"))
    assert sorted_rows(got, "offset", "n") == sorted_rows(expect, "offset", "n")


def test_adaptive_buckets_match_window_functions(spark):
    df = _df(spark, 400)
    w = Window.partitionBy("userId").orderBy("ts", "offset")
    expect = df.select("offset", F.row_number().over(w).cast("bigint").alias("n"),
                       F.max("itemId").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("m"))
    # about 20 rows per bucket: every group spans several buckets
    got_n = running_aggregate(df, ["userId"], ["ts", "offset"], "count", "n", rows_per_bucket=20)
    got_m = running_aggregate(df, ["userId"], ["ts", "offset"], "max", "m", value="itemId",
                              inclusive=False, rows_per_bucket=20)
    got = got_n.select("offset", "n").join(got_m.select("offset", "m"), "offset")
    assert sorted_rows(got, "offset", "n", "m") == sorted_rows(expect, "offset", "n", "m")
    buckets = df.select(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)).distinct().count()
    assert buckets > 20


def test_width_from_a_cheaper_superset(spark):
    df = _df(spark, 300)
    subset = df.where(F.col("itemId") % 2 == 0)
    w = Window.partitionBy("userId").orderBy("ts", "offset")
    expect = subset.select("offset", F.row_number().over(w).cast("bigint").alias("n"))
    got = running_aggregate(subset, ["userId"], ["ts", "offset"], "count", "n", rows_per_bucket=15,
                            width_source=df.select("ts"))
    assert sorted_rows(got, "offset", "n") == sorted_rows(expect, "offset", "n")
