"""Kafka and socket sources/sinks.

The Kafka connector jar is not part of a plain PySpark install; these
builders produce the standard ``kafka`` reader/writer and only fail when the
query starts.  Socket input is for demos: tests feed the same parsers from
text files instead of opening a port.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source_options(bootstrap_servers: str, topic: str,
                         starting_offsets: str = "latest", **extra: str) -> dict[str, str]:
    """S3: options of a Kafka source reading string values of one topic."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    opts.update(extra)
    return opts


def read_kafka_lines(spark: SparkSession, bootstrap_servers: str, topic: str,
                     starting_offsets: str = "latest", **extra: str) -> DataFrame:
    """Kafka values as text lines, with the partition and offset that order arrivals."""
    raw = (spark.readStream.format("kafka")
           .options(**kafka_source_options(bootstrap_servers, topic, starting_offsets, **extra))
           .load())
    return raw.select(F.col("value").cast("string").alias("value"),
                      F.col("partition").alias("source"), F.col("offset"))


def socket_source_options(host: str, port: int) -> dict[str, str]:
    """Options of a socket text-line source."""
    return {"host": host, "port": str(port)}


def read_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    return spark.readStream.format("socket").options(**socket_source_options(host, port)).load()


def kafka_sink_options(bootstrap_servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}


def replay_lines_to_kafka(spark: SparkSession, path: str, bootstrap_servers: str, topic: str) -> None:
    """Publish every line of a text file as one Kafka message (a batch job,
    written in parallel by the executors)."""
    (spark.read.text(path).select(F.col("value"))
     .write.format("kafka").options(**kafka_sink_options(bootstrap_servers, topic)).save())
