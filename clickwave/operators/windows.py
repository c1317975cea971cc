"""Event-time window assignment and windowed counts.

Windows are epoch-aligned and half-open ``[start, end)``, like Spark's
``window()``.  Results carry the window by its end, ``window_end``.

Sliding windows: Spark's ``window(ts, size, slide)`` copies each input row
into ``size/slide`` windows before aggregating.  The *pane* form counts once
per ``slide``-wide pane (a tumbling window, so partial aggregation collapses
the rows first) and then adds each pane count into the ``size/slide`` windows
that contain it.  The *run* form goes further for long windows over short
slides: a pane adds ``+c`` at its first window end and ``-c`` one window
length later, and a running sum of those changes gives the count as
constant runs of window ends, without materialising every window.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwave.operators.scan import running_aggregate
from clickwave.operators.timeutil import interval, plus_seconds, seconds


def window_end(ts: Column | str, size: int | str) -> Column:
    """Tumbling window end."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.window(ts, f"{seconds(size)} seconds").end


def _counter(count_col: str | None) -> Column:
    # A2: count(itemId) counts non-null keys; A1 counts rows
    return F.count(F.col(count_col)) if count_col else F.count(F.lit(1))


def tumbling_counts(df: DataFrame, keys: list[str], ts: str, size: int | str,
                    count_col: str | None = None, out: str = "cnt") -> DataFrame:
    """Count per key and tumbling window (A1 on W1/W3)."""
    return (df.groupBy(*keys, window_end(ts, size).alias("window_end"))
            .agg(_counter(count_col).alias(out)))


def sliding_counts(df: DataFrame, keys: list[str], ts: str, size: int | str, slide: int | str,
                   method: str = "pane", count_col: str | None = None,
                   out: str = "cnt") -> DataFrame:
    """Count per key and sliding window (A1 on W2/W4/W5) -> keys, window_end, out.

    ``method``: ``pane`` (default) collapses rows per (key, pane) before
    copying them into windows, so a hot key costs one row per pane however
    many rows it has -- one extra shuffle of pane counts.  ``expand`` copies
    raw rows map-side and shuffles once; it wins when keys are sparse (about
    one row per key and pane) and loses by the density factor on hot keys.
    ``native`` is Spark's ``window(ts, size, slide)``.  Panes are as wide as the
    greatest common divisor of size and slide, so neither needs to divide the
    other.
    """
    size_s, slide_s = seconds(size), seconds(slide)
    if method == "native":
        w = F.window(F.col(ts), f"{size_s} seconds", f"{slide_s} seconds")
        return (df.groupBy(*keys, w.end.alias("window_end"))
                .agg(_counter(count_col).alias(out)))
    pane_s = gcd(size_s, slide_s)  # the slide itself where it divides the size
    if method == "expand":
        # sparse keys: copy raw rows to their window ends map-side, one shuffle
        extra = [count_col] if count_col and count_col not in keys else []
        rows = _in_windows(df.select(*keys, *extra, window_end(ts, pane_s).alias("_pane_end")), size_s, slide_s, pane_s)
        return rows.groupBy(*keys, "window_end").agg(_counter(count_col).alias(out))
    if method != "pane":
        raise ValueError(f"unknown method {method}")
    panes = (df.groupBy(*keys, window_end(ts, pane_s).alias("_pane_end"))
             .agg(_counter(count_col).alias("_c")))
    if size_s == slide_s:
        return panes.select(*keys, F.col("_pane_end").alias("window_end"), F.col("_c").alias(out))
    return _in_windows(panes, size_s, slide_s, pane_s).groupBy(*keys, "window_end").agg(F.sum("_c").alias(out))


def _in_windows(panes: DataFrame, size_s: int, slide_s: int, pane_s: int) -> DataFrame:
    """``panes`` once for each window that contains them, ``_pane_end`` replaced
    by ``window_end``.  Windows start on the slide grid: the last one starts at
    or before the pane, the first one ends at or after it."""
    pane = F.col("_pane_end")
    last = plus_seconds(pane, size_s - pane_s)
    if pane_s != slide_s:
        last = plus_seconds(window_end(plus_seconds(pane, -pane_s), slide_s), size_s - slide_s)
    rows = panes if size_s >= slide_s else panes.where(pane <= last)  # between two windows: in none
    ends = F.sequence(last, pane, F.expr(f"INTERVAL '-{slide_s}' SECOND")) if pane_s != slide_s else F.sequence(pane, last, interval(slide_s))
    return rows.withColumn("window_end", F.explode(ends)).drop("_pane_end")


def sliding_distinct_sketch(df: DataFrame, ts: str, size: int | str, slide: int | str, col: str, out: str = "uv",
                            lg_k: int = 12) -> DataFrame:
    """A6/A7 on sliding windows: estimated number of distinct ``col`` per window.

    Distinct counts of panes don't add up, their HyperLogLog sketches do: one
    sketch per pane, built map-side, is merged into the windows that contain
    it.  A window costs ``2 ** lg_k`` bytes a pane, however many values it has;
    the relative standard error is about ``1.04 / sqrt(2 ** lg_k)``.
    """
    size_s, slide_s = seconds(size), seconds(slide)
    pane_s = gcd(size_s, slide_s)
    panes = df.groupBy(window_end(ts, pane_s).alias("_pane_end")).agg(F.hll_sketch_agg(col, lg_k).alias("_s"))
    spread = _in_windows(panes, size_s, slide_s, pane_s)
    return spread.groupBy("window_end").agg(F.hll_sketch_estimate(F.hll_union_agg("_s")).alias(out))


def sliding_distinct_count(df: DataFrame, ts: str, size: int | str, slide: int | str, col: str, out: str = "uv") -> DataFrame:
    """Exact number of distinct ``col`` per sliding window: values are taken
    once per pane first, then once per window."""
    size_s, slide_s = seconds(size), seconds(slide)
    pane_s = gcd(size_s, slide_s)
    panes = df.where(F.col(col).isNotNull()).select(col, window_end(ts, pane_s).alias("_pane_end")).distinct()
    return _in_windows(panes, size_s, slide_s, pane_s).groupBy("window_end").agg(F.count_distinct(col).alias(out))


def sliding_count_runs(df: DataFrame, keys: list[str], ts: str, size: int | str,
                       slide: int | str, out: str = "cnt",
                       bucket_seconds: int | None = None) -> DataFrame:
    """Sliding-window counts as runs of window ends with the same count.

    Returns ``keys, window_end_from, window_end_until, out``: every window end
    ``e`` with ``from <= e < until`` and ``(e - from) % slide == 0`` has count
    ``out``; windows without rows are not covered, as no window is emitted for
    them.  Requires ``size % slide == 0``.
    """
    size_s, slide_s = seconds(size), seconds(slide)
    if size_s % slide_s:
        raise ValueError("window size must be a multiple of the slide")
    panes = (df.groupBy(*keys, window_end(ts, slide_s).alias("pane_end"))
             .agg(F.count(F.lit(1)).alias("cnt")))
    return runs_from_panes(panes, keys, size_s, out=out, bucket_seconds=bucket_seconds)


def runs_from_panes(panes: DataFrame, keys: list[str], size: int | str, pane_col: str = "pane_end",
                    cnt_col: str = "cnt", out: str = "cnt", bucket_seconds: int | None = None) -> DataFrame:
    """Runs of window ends from pane counts (``keys, pane_end, cnt``): a pane
    adds its count at its own end and removes it one window length later."""
    size_s = seconds(size)
    p = panes.select(*keys, F.col(pane_col).alias("_e"), F.col(cnt_col).cast("bigint").alias("_d"))
    expire = p.select(*keys, plus_seconds(F.col("_e"), size_s).alias("_e"), (-F.col("_d")).alias("_d"))
    changes = (p.unionByName(expire).groupBy(*keys, "_e").agg(F.sum("_d").alias("_d"))
               .where(F.col("_d") != 0))
    runs = running_aggregate(changes, keys, ["_e"], how="sum", value="_d", out=out,
                             next_of="_e", next_out="window_end_until",
                             bucket_seconds=bucket_seconds)
    return (runs.where(F.col(out) > 0)
            .select(*keys, F.col("_e").alias("window_end_from"), "window_end_until", out))


#: Window ends that one row of a long run is spread into at a time.
ENDS_PER_STEP = 10_000


def expand_runs(runs: DataFrame, slide: int | str, after=None, upto=None) -> DataFrame:
    """Runs -> one row per window end; optionally only ends in ``(after, upto]``
    (bounds on the slide grid, as literals or columns)."""
    slide_s = seconds(slide)
    start, stop = F.col("window_end_from"), plus_seconds(F.col("window_end_until"), -slide_s)
    if after is not None:
        start = F.greatest(start, plus_seconds(_as_col(after), slide_s))
    if upto is not None:
        stop = F.least(stop, _as_col(upto))
    keep = [c for c in runs.columns if c not in ("window_end_from", "window_end_until")]
    # a steady key has one run over its whole history: spread it in two steps
    step = slide_s * ENDS_PER_STEP
    parts = (runs.where(start <= stop).select(*keep, stop.alias("_stop"),
                                              F.explode(F.sequence(start, stop, interval(step))).alias("_start")))
    last = F.least(F.col("_stop"), plus_seconds(F.col("_start"), step - slide_s))
    return parts.select(*keep, F.explode(F.sequence(F.col("_start"), last, interval(slide_s))).alias("window_end"))


def _as_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)
