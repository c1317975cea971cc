"""Text-line parsing.

Lines are split by position and every field goes through ``try_cast``: a bad
field becomes null instead of failing the job (ANSI mode would raise).  The
caller decides what to do with rows whose required fields are null -- see
:func:`clickwave.sources.text.split_rejects`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the web-log time format, day first.
WEB_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def _field(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i))


def _try_cast(c: Column, to: str) -> Column:
    return F.trim(c).try_cast(to)


def to_event_time(c: Column, ntz: bool = True) -> Column:
    """Normalise any timestamp column to the event-time type used by the jobs.

    Batch jobs keep ``TIMESTAMP_NTZ`` (the driver tables' type); streaming
    jobs need ``TIMESTAMP`` because watermarks refuse NTZ.  With the session
    zone pinned to UTC the two casts are exact inverses.
    """
    return c.cast("timestamp_ntz" if ntz else "timestamp")


def seconds_to_event_time(c: Column, ntz: bool = True) -> Column:
    return to_event_time(F.timestamp_seconds(c), ntz)


def millis_to_event_time(c: Column, ntz: bool = True) -> Column:
    return to_event_time(F.timestamp_millis(c), ntz)


def parse_user_behavior_line(line: Column) -> Column:
    """``userId,itemId,categoryId,behavior,timestamp`` -> struct."""
    p = F.split(line, ",")
    return F.struct(
        _try_cast(_field(p, 0), "bigint").alias("userId"),
        _try_cast(_field(p, 1), "bigint").alias("itemId"),
        _try_cast(_field(p, 2), "int").alias("categoryId"),
        _field(p, 3).alias("behavior"),
        _try_cast(_field(p, 4), "bigint").alias("timestamp"),
    )


def parse_ad_click_line(line: Column) -> Column:
    """``userId,adId,province,city,timestamp`` -> struct."""
    p = F.split(line, ",")
    return F.struct(
        _try_cast(_field(p, 0), "bigint").alias("userId"),
        _try_cast(_field(p, 1), "bigint").alias("adId"),
        _field(p, 2).alias("province"),
        _field(p, 3).alias("city"),
        _try_cast(_field(p, 4), "bigint").alias("timestamp"),
    )


def parse_web_log_line(line: Column) -> Column:
    """Space-separated web-log line -> struct from fields 0,1,3,5,6.

    ``timestamp`` is epoch milliseconds of the day-first local time, read in
    the session zone (UTC); ``ts`` is the same instant as event time.
    """
    p = F.split(line, " ")
    ts = F.try_to_timestamp(_field(p, 3), F.lit(WEB_LOG_TIME_FORMAT))
    return F.struct(
        _field(p, 0).alias("ip"),
        _field(p, 1).alias("userId"),
        F.unix_millis(ts).alias("timestamp"),
        _field(p, 5).alias("method"),
        _field(p, 6).alias("url"),
        to_event_time(ts).alias("ts"),
    )
