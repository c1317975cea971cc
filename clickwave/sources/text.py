"""Delimited-text sources (S1, S2) and line parsers for Kafka/socket values.

All readers take an explicit schema; nothing is inferred.  Event time is
added as ``ts`` (see :func:`clickwave.functions.to_event_time`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwave import schemas
from clickwave.functions.parsing import (
    parse_ad_click_line, parse_user_behavior_line, parse_web_log_line,
    seconds_to_event_time,
)


def _with_seconds_time(df: DataFrame, ntz: bool) -> DataFrame:
    return df.withColumn("ts", seconds_to_event_time(F.col("timestamp"), ntz))


#: Fields without which a record is a reject.
USER_BEHAVIOR_REQUIRED = ["userId", "itemId", "behavior", "timestamp"]
AD_CLICK_REQUIRED = ["userId", "adId", "province", "timestamp"]


def read_user_behavior(spark: SparkSession, path: str, streaming: bool = False,
                       ntz: bool | None = None, strict: bool = False, **options) -> DataFrame:
    """Comma-separated user-behaviour files, no header.  Bad fields become
    null; with ``strict`` a record without its required fields fails the job."""
    reader = spark.readStream if streaming else spark.read
    df = reader.schema(schemas.USER_BEHAVIOR).options(header="false", **options).csv(path)
    if strict:
        df = fail_on_rejects(df, USER_BEHAVIOR_REQUIRED)
    return _with_seconds_time(df, ntz=not streaming if ntz is None else ntz)


def read_ad_clicks(spark: SparkSession, path: str, streaming: bool = False,
                   ntz: bool | None = None, strict: bool = False, **options) -> DataFrame:
    """Comma-separated ad-click files, no header; ``strict`` as in
    :func:`read_user_behavior`."""
    reader = spark.readStream if streaming else spark.read
    df = reader.schema(schemas.AD_CLICK).options(header="false", **options).csv(path)
    if strict:
        df = fail_on_rejects(df, AD_CLICK_REQUIRED)
    return _with_seconds_time(df, ntz=not streaming if ntz is None else ntz)


def user_behavior_from_lines(lines: DataFrame, col: str = "value", ntz: bool = True) -> DataFrame:
    """P1 over a line column (Kafka value, socket line)."""
    rest = [c for c in lines.columns if c != col]
    df = lines.select(*rest, parse_user_behavior_line(F.col(col).cast("string")).alias("r")).select(*rest, "r.*")
    return _with_seconds_time(df, ntz)


def ad_clicks_from_lines(lines: DataFrame, col: str = "value", ntz: bool = True) -> DataFrame:
    """P2 over a line column."""
    rest = [c for c in lines.columns if c != col]
    df = lines.select(*rest, parse_ad_click_line(F.col(col).cast("string")).alias("r")).select(*rest, "r.*")
    return _with_seconds_time(df, ntz)


def web_log_from_lines(lines: DataFrame, col: str = "value", ntz: bool = True) -> DataFrame:
    """P3/P4 over a line column; ``ts`` has whole seconds."""
    rest = [c for c in lines.columns if c != col]
    df = lines.select(*rest, parse_web_log_line(F.col(col).cast("string")).alias("r")).select(*rest, "r.*")
    return df if ntz else df.withColumn("ts", F.col("ts").cast("timestamp"))


def split_rejects(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required field present, and the rest."""
    ok = _present(required)
    return df.where(ok), df.where(~ok)


def _present(required: list[str]):
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return ok


def fail_on_rejects(df: DataFrame, required: list[str]) -> DataFrame:
    """Strict reading, batch or stream: the job fails on the first row that
    lacks a required field."""
    message = F.concat(F.lit("bad record: "), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return df.where(F.when(_present(required), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def count_rejects(df: DataFrame, required: list[str], observation) -> DataFrame:
    """``df`` as it is, with the number of rejects observed as ``rejects``.

    ``observation``: an ``Observation`` for a batch job, or a name, under which
    every micro-batch reports it in its progress.
    """
    return df.observe(observation, F.count_if(~_present(required)).alias("rejects"))
