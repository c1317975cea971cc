"""App marketing: counts per (channel, behaviour) and in total, 1 h windows every 5 s."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwave.functions.predicates import not_equal_keep_null
from clickwave.operators.windows import expand_runs, sliding_count_runs, sliding_counts

SIZE, SLIDE = "1 hour", "5 seconds"
UNINSTALL = "UNINSTALL"


def _kept(events: DataFrame, uninstall: str) -> DataFrame:
    return events.where(not_equal_keep_null("behavior", uninstall))


def by_channel_runs(events: DataFrame, uninstall: str = UNINSTALL, size=SIZE, slide=SLIDE) -> DataFrame:
    """F2 + A5 + W2 as runs: channel, behavior, window_end_from, window_end_until, cnt."""
    return sliding_count_runs(_kept(events, uninstall).select("channel", "behavior", "ts"),
                              ["channel", "behavior"], "ts", size, slide)


def by_channel(events: DataFrame, uninstall: str = UNINSTALL, size=SIZE, slide=SLIDE) -> DataFrame:
    """One row per (channel, behavior, window_end) -> ..., cnt."""
    return expand_runs(by_channel_runs(events, uninstall, size, slide), slide)


def total_runs(events: DataFrame, uninstall: str = UNINSTALL, size=SIZE, slide=SLIDE) -> DataFrame:
    return sliding_count_runs(_kept(events, uninstall).select("ts"), [], "ts", size, slide)


def total(events: DataFrame, uninstall: str = UNINSTALL, size=SIZE, slide=SLIDE) -> DataFrame:
    """P6 + W2: ("total", 1) per window -> channel, behavior, window_end, cnt."""
    dense = expand_runs(total_runs(events, uninstall, size, slide), slide)
    return dense.select(F.lit("total").alias("channel"), F.lit("total").alias("behavior"),
                        "window_end", "cnt")

