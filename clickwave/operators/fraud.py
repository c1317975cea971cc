"""Click-fraud cap with blacklist alerts and a daily reset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwave.functions.formatting import alert_message
from clickwave.operators.ranking import top_n
from clickwave.operators.timeutil import plus_seconds

# Fixed value: counts reset at midnight UTC+8.
RESET_OFFSET_HOURS = 8


def reset_day(ts: Column, offset_hours: int = RESET_OFFSET_HOURS) -> Column:
    """Event-time calendar day at UTC+offset (D3)."""
    return F.to_date(plus_seconds(ts, offset_hours * 3600))


def cap_clicks(df: DataFrame, keys: list[str], cap: int, ts: str = "ts",
               order: list[str] | None = None, daily_reset: bool = True,
               offset_hours: int = RESET_OFFSET_HOURS) -> DataFrame:
    """Tag the first ``cap`` clicks per key (and day) ``ok`` and the next one
    ``alert``; later clicks are dropped (R5, R6, R7).

    Only ``cap + 1`` rows per group are ever needed, so the rank filter is a
    window-group limit: each map task forwards at most ``cap + 1`` rows of a
    group, however many clicks one bot makes.  Clicks without a time are
    rejects: they belong to no day and are left out.
    """
    order = order or []
    df = df.where(F.col(ts).isNotNull())
    groups = list(keys)
    if daily_reset:
        df = df.withColumn("day", reset_day(F.col(ts), offset_hours))
        groups.append("day")
    ranked = top_n(df, groups, [F.col(ts), *[F.col(c) for c in order]], cap + 1, "click_rank")
    return ranked.withColumn("kind", F.when(F.col("click_rank") <= cap, "ok").otherwise("alert"))


def passed_clicks(capped: DataFrame) -> DataFrame:
    return capped.where(F.col("kind") == "ok").drop("kind", "click_rank")


def blacklist_alerts(capped: DataFrame, keys: list[str], cap: int, ts: str = "ts") -> DataFrame:
    extra = ["day"] if "day" in capped.columns else []
    return (capped.where(F.col("kind") == "alert")
            .select(*keys, *extra, F.col(ts), alert_message(cap).alias("warning_msg")))
