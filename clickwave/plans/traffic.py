"""Page views and unique visitors per hour (PV, UV: exact, bitmap, running)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwave.functions.predicates import equals
from clickwave.operators.aggregates import (
    bitmap_distinct_count, distinct_count, running_distinct_count, salted_count, tumbling_sum,
)

from clickwave.operators.windows import sliding_distinct_count, sliding_distinct_sketch

PAGE_VIEW = "pv"
HOUR = "1 hour"


def _views(behavior: DataFrame, page_view: str) -> DataFrame:
    return behavior.where(equals("behavior", page_view))


def page_views(behavior: DataFrame, page_view: str = PAGE_VIEW, size=HOUR) -> DataFrame:
    """P6 + A3 + W1: ("pv", 1) summed per hour -> key, window_end, cnt."""
    ones = _views(behavior, page_view).select("ts", F.lit(1).cast("bigint").alias("one"))
    return tumbling_sum(ones, "ts", size, "one").select(F.lit("pv").alias("key"), "window_end", "cnt")


def page_views_salted(behavior: DataFrame, page_view: str = PAGE_VIEW, size=HOUR,
                      salts: int = 10) -> DataFrame:
    """P7 + A4: count per (salt, hour), then total per hour."""
    salt = ["offset"] if "offset" in behavior.columns else ["ts", "userId"]
    rows = _views(behavior, page_view).select(*dict.fromkeys(["ts", *salt]))
    return salted_count(rows, "ts", size, salts, salt).select(F.lit("pv").alias("key"), "window_end", "cnt")


def unique_visitors(behavior: DataFrame, page_view: str = PAGE_VIEW, size=HOUR) -> DataFrame:
    """A6 + W3: exact distinct users per hour -> key, window_end, uv."""
    return distinct_count(_views(behavior, page_view), "ts", size, "userId").select(
        F.lit("uv").alias("key"), "window_end", "uv")


def unique_visitors_bitmap(behavior: DataFrame, page_view: str = PAGE_VIEW, size=HOUR) -> DataFrame:
    """A7 + P12: distinct bitmap offsets per hour -> key, window_end, uv."""
    return bitmap_distinct_count(_views(behavior, page_view), "ts", size, "userId").select(
        F.lit("uv").alias("key"), "window_end", "uv")


def unique_visitors_running(behavior: DataFrame, page_view: str = PAGE_VIEW, size=HOUR,
                            bucket_seconds: int | None = None) -> DataFrame:
    """The running UV of each hour, one row per newly seen visitor
    -> key, window_end, ts, uv_count."""
    rows = _views(behavior, page_view).select("userId", "ts")
    return running_distinct_count(rows, "ts", size, "userId", bucket_seconds=bucket_seconds).select(
        F.lit("uv").alias("key"), "window_end", "ts", "uv_count")


def unique_visitors_sliding(behavior: DataFrame, page_view: str = PAGE_VIEW, size=HOUR, slide="5 minutes",
                            lg_k: int = 12) -> DataFrame:
    """Unique visitors per sliding window from merged sketches, beside the
    exact number -> window_end, uv, uv_estimate, within: whether the two differ
    by at most five standard errors and one visitor."""
    views = _views(behavior, page_view)
    exact = sliding_distinct_count(views, "ts", size, slide, "userId")
    estimate = sliding_distinct_sketch(views, "ts", size, slide, "userId", "uv_estimate", lg_k)
    bound = 5 * 1.04 / 2 ** (lg_k / 2) * F.col("uv") + 1
    return (exact.join(estimate, "window_end")
            .withColumn("within", F.abs(F.col("uv_estimate") - F.col("uv")) <= bound))
