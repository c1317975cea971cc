"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_PER_BATCH = 1000


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small enough for batches of very long texts; a value
    that the session's owner has already lowered is left alone."""
    if int(spark.conf.get(BATCH_ROWS, "10000")) > ROWS_PER_BATCH:
        spark.conf.set(BATCH_ROWS, str(ROWS_PER_BATCH))
    return spark


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast when it has at most ``max_rows`` rows, else
    ``df`` itself, for Spark to join by sorting.

    The rows are counted (and, below the bound, held as a local relation), so
    the broadcast never rests on an estimate.
    """
    spark = df.sparkSession
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(spark.createDataFrame(rows, df.schema))
