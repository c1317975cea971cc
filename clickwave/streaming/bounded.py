"""The end of a bounded stream.

A stream emits a window once the watermark has passed its end; when its input
ends, the last windows are still open and stay in the state of the query.  The
functions here read them back, from the checkpoint of the finished query with
Spark's state reader, so that a job over files gives every window.  A query
that is only paused must not be flushed: its open windows are still to come.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwave.streaming.jobs import runs_from_seconds


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None) -> DataFrame | None:
    """What a finished query holds in its state: the columns of the keys, then
    those of the values; None if it never ran a micro-batch.

    ``operator`` counts from the last stateful operator back to the source;
    ``variable`` is the state variable of a ``transformWithState``.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if variable:
        reader = reader.option("stateVarName", variable)
    try:
        return reader.load(checkpoint).select("key.*", "value.*")
    except PySparkException as e:
        if e.getCondition() and e.getCondition().startswith(("STDS_NO_COMMITTED_BATCH", "STDS_OFFSET_LOG_UNAVAILABLE",
                                                             "STDS_COMMITTED_BATCH_UNAVAILABLE")):
            return None
        raise


def open_counts(spark: SparkSession, checkpoint: str, columns: list[str], operator: int = 0) -> DataFrame | None:
    """Counts that a streaming window aggregation still holds, its grouping
    columns named ``columns`` (``window`` becomes ``window_end``)."""
    rows = state_rows(spark, checkpoint, operator)
    if rows is None:
        return None
    rows = rows.toDF(*columns, "cnt")
    return rows.withColumn("window", F.col("window.end")).withColumnRenamed("window", "window_end")


def open_runs(spark: SparkSession, checkpoint: str, keys: list[str]) -> DataFrame | None:
    """Runs that ``sliding_runs_stream`` still holds."""
    rows = state_rows(spark, checkpoint, variable="runs")
    if rows is None:
        return None
    steps = F.expr("transform(sequence(0, size(at) - 2), i -> struct(at[i] AS window_end_from, at[i + 1] AS window_end_until, cnt[i] AS cnt))")
    runs = rows.where(F.size("at") > 1).select(*keys, F.explode(steps).alias("r")).select(*keys, "r.*")
    return runs_from_seconds(runs.where(F.col("cnt") > 0), keys)


def open_page_lists(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """Lists of the windows that ``page_pane_updates`` has not issued yet."""
    rows = state_rows(spark, checkpoint, variable="lists")
    if rows is None:
        return None
    lists = rows.select(F.explode(F.from_json("lists", "map<string, array<array<array<string>>>>")).alias("end", "held"))
    waiting = lists.where(F.col("held")[1].isNull()).select("end", F.explode(F.col("held")[0]).alias("page"))
    return waiting.select(F.timestamp_seconds(F.col("end").cast("long")).alias("window_end"), F.col("page")[1].alias("url"),
                          (-F.col("page")[0].cast("long")).alias("cnt"), F.lit(False).alias("was"), F.lit(False).alias("revised"))
