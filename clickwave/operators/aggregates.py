"""Window aggregates beyond plain counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwave.functions.hashing import bitmap_offset
from clickwave.operators.scan import running_aggregate
from clickwave.operators.windows import window_end


def tumbling_sum(df: DataFrame, ts: str, size, value: str, keys: list[str] | None = None,
                 out: str = "cnt") -> DataFrame:
    """A3: ``sum(value)`` per key and tumbling window."""
    keys = keys or []
    return (df.groupBy(*keys, window_end(ts, size).alias("window_end"))
            .agg(F.sum(value).alias(out)))


def salted_count(df: DataFrame, ts: str, size, salts: int = 10,
                 salt_cols: list[str] | None = None, out: str = "cnt") -> DataFrame:
    """A4: count per (salt, window), then total per window.

    The salt is a hash of ``salt_cols`` (default: every column), so a retried
    task puts each row under the same salt again; totals are the same as with
    a random salt.
    """
    cols = salt_cols or df.columns
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(salts)))
    part = (salted.groupBy("_salt", window_end(ts, size).alias("window_end"))
            .agg(F.count(F.lit(1)).alias("_c")))
    return part.groupBy("window_end").agg(F.sum("_c").alias(out))


def distinct_count(df: DataFrame, ts: str, size, col: str, out: str = "uv") -> DataFrame:
    """Exact number of distinct ``col`` per tumbling window.

    Spark plans a single ``count(DISTINCT)`` as two aggregations, the first
    keyed by (window, value), so one busy window is spread over many tasks.
    """
    return (df.groupBy(window_end(ts, size).alias("window_end"))
            .agg(F.count_distinct(col).alias(out)))


def bitmap_distinct_count(df: DataFrame, ts: str, size, col: str, out: str = "uv") -> DataFrame:
    """Distinct bitmap offsets of ``col`` per window.

    Each window's 2^29-bit bitmap is split into Spark's 32768-bit bitmap
    chunks; chunks are built map-side (``bitmap_construct_agg`` merges
    partially) and shuffled by (window, chunk), then bit counts are summed.
    Two values with the same offset count once, as in a one-hash bitmap.
    """
    off = bitmap_offset(F.col(col))
    chunks = (df.select(window_end(ts, size).alias("window_end"), off.alias("_off"))
              .groupBy("window_end", F.bitmap_bucket_number("_off").alias("_chunk"))
              .agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("_off"))).alias("_n")))
    return chunks.groupBy("window_end").agg(F.sum("_n").cast("bigint").alias(out))


def running_distinct_count(df: DataFrame, ts: str, size, col: str,
                           out: str = "uv_count", bucket_seconds: int | None = None) -> DataFrame:
    """One row each time a window sees a new bitmap offset of ``col``,
    carrying the number of offsets seen so far in that window.

    Rows arrive in ``ts`` order.  First sightings are found with a hash
    aggregation of the smallest time; their running count uses the bucketed
    scan, so no window is ranked in a single task.  Which of two visitors with
    the same first time is counted first does not show in the result.
    """
    firsts = (df.select(window_end(ts, size).alias("window_end"), bitmap_offset(F.col(col)).alias("_off"),
                        F.col(ts).alias("ts"))
              .groupBy("window_end", "_off").agg(F.min("ts").alias("ts")))
    # bucket widths from the raw rows: no second pass over the first-sightings aggregate
    ranked = running_aggregate(firsts, ["window_end"], ["ts", "_off"], how="count", out=out,
                               bucket_seconds=bucket_seconds, width_source=df.select(F.col(ts).alias("ts")))
    return ranked.select("window_end", "ts", out)
