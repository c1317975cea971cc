"""Ad clicks per province behind a per-user click cap with blacklist alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickwave.operators.fraud import blacklist_alerts, cap_clicks, passed_clicks
from clickwave.operators.windows import sliding_counts

# Fixed values of the job: 100 clicks per (user, ad) and day; 1 h windows every 5 min.
CAP = 100
KEYS = ["userId", "adId"]
SIZE, SLIDE = "1 hour", "5 minutes"


def capped(clicks: DataFrame, cap: int = CAP, keys=None, daily_reset: bool = True) -> DataFrame:
    """Clicks tagged ok/alert (see :func:`clickwave.operators.cap_clicks`)."""
    order = ["offset"] if "offset" in clicks.columns else []
    return cap_clicks(clicks, keys or KEYS, cap, "ts", order, daily_reset)


def passed(clicks: DataFrame, cap: int = CAP, keys=None, daily_reset: bool = True) -> DataFrame:
    return passed_clicks(capped(clicks, cap, keys, daily_reset))


def alerts(clicks: DataFrame, cap: int = CAP, keys=None, daily_reset: bool = True) -> DataFrame:
    return blacklist_alerts(capped(clicks, cap, keys, daily_reset), keys or KEYS, cap)


def by_province(clicks: DataFrame, cap: int = CAP, keys=None, daily_reset: bool = True,
                size=SIZE, slide=SLIDE) -> DataFrame:
    """A1 + W2 on the passed clicks -> province, window_end, cnt."""
    ok = passed(clicks, cap, keys, daily_reset).select("province", "ts")
    return sliding_counts(ok, ["province"], "ts", size, slide)
