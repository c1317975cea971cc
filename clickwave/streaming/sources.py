"""Streaming inputs and event-time handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwave.sources.events import read_table
from clickwave.sources.text import read_ad_clicks, read_user_behavior, web_log_from_lines


def as_stream_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; the driver tables store TIMESTAMP_NTZ (UTC)."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def with_event_time(df: DataFrame, delay: str = "0 seconds", col: str = "ts") -> DataFrame:
    """R1 (in order, delay 0) / R2 (bounded out-of-orderness)."""
    return df.withWatermark(col, delay)


def rows_where(df: DataFrame, condition: Column, col: str = "ts") -> DataFrame:
    """The rows that pass ``condition``, picked after the watermark.

    Event time is moved by every row of the log, also by those that a job
    leaves out.  Catalyst pushes a plain filter below the watermark, which then
    sees the rows that pass only; a predicate on the event time itself stays
    above it.  Rows without a time go as well.
    """
    return df.where(F.when(condition, F.col(col)) == F.col(col))


def event_table_stream(spark: SparkSession, sf_dir: str, name: str = "events",
                       max_files: int | None = None, max_bytes: str | None = None) -> DataFrame:
    """A driver table as a stream; a micro-batch takes at most ``max_files``
    files or ``max_bytes`` (as ``"4g"``)."""
    opts = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    if max_bytes:
        opts["maxBytesPerTrigger"] = max_bytes
    return as_stream_time(read_table(spark, sf_dir, name, streaming=True, **opts))


def user_behavior_stream(spark: SparkSession, path: str, max_files: int | None = 1) -> DataFrame:
    opts = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    return read_user_behavior(spark, path, streaming=True, **opts)


def ad_click_stream(spark: SparkSession, path: str, max_files: int | None = 1) -> DataFrame:
    opts = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    return read_ad_clicks(spark, path, streaming=True, **opts)


def web_log_stream(spark: SparkSession, path: str, max_files: int | None = 1) -> DataFrame:
    """Text files of web-log lines, parsed like socket/Kafka lines."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    lines = reader.text(path)
    return web_log_from_lines(lines, ntz=False)
