"""Duration parsing and interval arithmetic shared by the window operators."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "s": 1, "sec": 1, "second": 1, "seconds": 1, "secs": 1,
    "m": 60, "min": 60, "minute": 60, "minutes": 60, "mins": 60,
    "h": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "day": 86400, "days": 86400,
}


def seconds(spec: int | str) -> int:
    """``300``, ``"5 minutes"``, ``"1 hour"`` -> seconds."""
    if isinstance(spec, int):
        return spec
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", spec)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"bad duration: {spec!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def interval(secs: int) -> Column:
    return F.expr(f"INTERVAL '{int(secs)}' SECOND")


def plus_seconds(ts: Column, secs: int | Column) -> Column:
    """``ts + secs`` for TIMESTAMP and TIMESTAMP_NTZ alike."""
    if isinstance(secs, int):
        return ts + interval(secs)
    return ts + interval(1) * secs


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch (NTZ read as UTC)."""
    return F.unix_micros(ts.cast("timestamp"))
