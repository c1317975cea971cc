"""Distributed running aggregates ("prefix scans") over ordered groups.

``row_number``/running ``sum``/``max`` over ``Window.partitionBy(g)`` put a
whole group into one task.  Here a group is cut into consecutive time buckets
of its leading order column: each bucket is ranked in its own task, and the
carry from earlier buckets comes from a small per-bucket summary (one row per
non-empty bucket) that is prefix-summed and joined back.  The data itself is
shuffled once, on (group, bucket); a hot group spreads over as many tasks as
it has buckets, and a bucket holds at most ``rate x width`` rows however long
the input is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwave.operators.timeutil import epoch_micros

_AGG = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}
_CARRY = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}


def _position(df: DataFrame, col: str) -> Column:
    """The order column as a number: microseconds for timestamps."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(F.col(col))
    return F.col(col)


def _unit(df: DataFrame, col: str) -> int:
    dtype = df.schema[col].dataType
    return 1_000_000 if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else 1


def _bucket(df: DataFrame, col: str, width: int | None, rows_per_bucket: int,
            source: DataFrame | None = None) -> Column:
    """``floor(position / width)``.  Without a width it adapts to the data:
    ``span x rows_per_bucket / rows`` from a scalar subquery planned with the
    query (mergeable sketches, no driver round trip), so on average no
    group's bucket exceeds ``rows_per_bucket`` rows however fast data arrives.
    The span is that between the 1st and the 99th percentile: single rows far
    outside get buckets of their own instead of widening all others."""
    pos = _position(df, col)
    if width is not None:
        return F.floor(pos / F.lit(width * _unit(df, col)))
    src = source if source is not None else df
    spos = _position(src, col)
    inner = F.percentile_approx(spos, [0.01, 0.99], 1000)
    stats = src.select(
        F.coalesce(
            F.greatest(F.lit(1), F.ceil((inner[1] - inner[0] + F.lit(1)) * F.lit(rows_per_bucket)
                                        / F.greatest(F.count(F.lit(1)) * F.lit(0.98), F.lit(1)))),
            F.lit(1)).cast("bigint").alias("w"))
    return F.floor(pos / stats.scalar())


def running_aggregate(df: DataFrame, partition_by: list[str], order_by: list[str],
                      how: str, out: str, value: str | None = None,
                      inclusive: bool = True, next_of: str | None = None,
                      next_out: str | None = None, bucket_seconds: int | None = None,
                      rows_per_bucket: int = 1_000_000,
                      width_source: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = running ``how`` of ``value`` within ``partition_by`` in
    ``order_by`` order (inclusive of the current row, or up to the preceding
    row), and optionally ``next_out`` = ``next_of`` of the following row.

    ``order_by[0]`` must be a timestamp or number: buckets are
    ``floor(order_by[0] / width)``, so the bucket order agrees with the row
    order.  ``bucket_seconds`` fixes the width (timestamps in seconds);
    by default it adapts to ``rows_per_bucket``, measured on ``width_source``
    when given: a cheaper frame with the same order column whose rows are a
    superset in time (its density bounds ``df``'s).  ``order_by`` should make
    the order total (append a unique id) for a deterministic result.
    """
    if how not in _AGG:
        raise ValueError(f"unsupported running aggregate: {how}")
    if how != "count" and value is None:
        raise ValueError("value is required")
    keyed = df.withColumn("_bkt", _bucket(df, order_by[0], bucket_seconds, rows_per_bucket, width_source))

    # 1. rank inside each (group, bucket): the one shuffle of the data
    in_bucket = Window.partitionBy(*partition_by, "_bkt").orderBy(*order_by)
    frame = in_bucket.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = keyed.withColumn("_local", (F.count(F.lit(1)) if how == "count" else _AGG[how](value)).over(frame))
    if next_of is not None:
        local = local.withColumn("_local_next", F.lead(next_of).over(in_bucket))

    # 2. per-bucket summary from the same partitioned output (no new shuffle of
    #    the data, and the exchange above is shared), carried across buckets
    summary_aggs = [(F.count(F.lit(1)) if how == "count" else _AGG[how](value)).alias("_bagg")]
    if next_of is not None:
        summary_aggs.append(F.min(next_of).alias("_bmin"))
    summary = local.groupBy(*partition_by, "_bkt").agg(*summary_aggs)
    over_buckets = Window.partitionBy(*partition_by).orderBy("_bkt")
    carry_cols = [_CARRY[how]("_bagg").over(over_buckets.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry")]
    if next_of is not None:
        carry_cols.append(F.lead("_bmin").over(over_buckets).alias("_next_bmin"))
    carry = summary.select(*partition_by, "_bkt", *carry_cols)

    # 3. join the carry back; the data side is already partitioned by (group, bucket)
    cond = [local[k].eqNullSafe(carry[k]) for k in partition_by] + [local["_bkt"] == carry["_bkt"]]
    joined = local.join(carry, cond, "inner").select(local["*"], *[carry[c] for c in carry.columns
                                                                 if c not in partition_by and c != "_bkt"])
    if how in ("count", "sum"):
        total = F.coalesce(F.col("_carry"), F.lit(0)) + F.coalesce(F.col("_local"), F.lit(0))
    elif how == "max":
        total = F.greatest(F.col("_carry"), F.col("_local"))
    else:
        total = F.least(F.col("_carry"), F.col("_local"))
    res = joined.withColumn(out, total)
    drop = ["_bkt", "_carry", "_local"]
    if next_of is not None:
        res = res.withColumn(next_out or f"next_{next_of}", F.coalesce(F.col("_local_next"), F.col("_next_bmin")))
        drop += ["_local_next", "_next_bmin"]
    return res.drop(*drop)
