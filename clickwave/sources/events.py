"""Adapters from the driver's ``events`` table to the reference's records.

Mapping (all derived per row, no lookups):

* user behaviour: userId <- user_id, itemId <- props.k, behavior <- event_type
  (``view`` plays the page-view role), time <- ts.
* web log: a text line built from the row, then parsed like any other log
  line: ip and user from user_id, method GET unless event_type = 'error'
  (POST), url ``/p/<k>`` plus a suffix picked by ``k % 6``.
* marketing: channel by ``user_id % 3``, behavior <- event_type (``signup``
  plays the uninstall role).
* ad clicks: adId <- props.k % 5 (few ads, so that the cap bites), province ``prov_<user_id % 7>``, city
  ``city_<user_id % 9>``.

``offset`` carries ``event_id``: the arrival position a Kafka offset or line
number gives real sources, used to order ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwave.sources.text import web_log_from_lines

EVENT_TABLES = ("events",)

# Fixed values of the mapping.
URL_SUFFIXES = ["", ".html", ".css", ".js", ".png", ".ico"]
ADS = 5
CHANNELS = ["apps store", "wechat", "weibo"]


def read_table(spark: SparkSession, sf_dir: str, name: str, streaming: bool = False,
               **options) -> DataFrame:
    """One driver table: a parquet file or a folder of part files.

    A file stream watches a folder.  If the table is one, the stream reads all
    of it; if it is a file, the stream picks that file by name.  A table
    without any file is an error, not an empty stream.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if not streaming:
        return spark.read.parquet(path)
    from clickwave import schemas
    files = spark.read.schema(schemas.EVENTS).parquet(path).inputFiles()
    if not files:
        raise FileNotFoundError(f"no file in {path}")
    reader = spark.readStream.schema(schemas.EVENTS).options(**options)
    if f"/{name}.parquet/" in files[0]:
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def item_key(props: Column) -> Column:
    return F.get_json_object(props, "$.k").try_cast("bigint")


def user_behavior_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("userId"),
        item_key(F.col("props")).alias("itemId"),
        F.lit(None).cast("int").alias("categoryId"),
        F.col("event_type").alias("behavior"),
        F.col("ts"),
        F.col("event_id").alias("offset"),
    )


def web_log_lines_from_events(events: DataFrame) -> DataFrame:
    """Apache-style lines ``ip user - dd/MM/yyyy:HH:mm:ss +0000 METHOD url``."""
    uid = F.col("user_id")
    k = item_key(F.col("props"))
    ip = F.concat_ws(".", F.lit("10"), F.pmod(F.floor(uid / 65536), F.lit(256)).cast("string"),
                     F.pmod(F.floor(uid / 256), F.lit(256)).cast("string"),
                     F.pmod(uid, F.lit(256)).cast("string"))
    method = F.when(F.col("event_type") == "error", "POST").otherwise("GET")
    suffix = F.element_at(F.array(*[F.lit(s) for s in URL_SUFFIXES]), (F.pmod(k, F.lit(6)) + 1).cast("int"))
    url = F.concat(F.lit("/p/"), k.cast("string"), suffix)
    line = F.concat_ws(" ", ip, uid.cast("string"), F.lit("-"),
                       F.date_format(F.col("ts"), "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), method, url)
    return events.select(line.alias("value"), F.col("event_id").alias("offset"),
                         F.col("user_id"))


def web_log_from_events(events: DataFrame) -> DataFrame:
    return web_log_from_lines(web_log_lines_from_events(events))


def marketing_from_events(events: DataFrame) -> DataFrame:
    channel = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]),
                           (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("int"))
    return events.select(
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("behavior"),
        channel.alias("channel"),
        F.col("ts"),
        F.col("event_id").alias("offset"),
    )


def ad_clicks_from_events(events: DataFrame) -> DataFrame:
    uid = F.col("user_id")
    return events.select(
        uid.alias("userId"),
        F.pmod(item_key(F.col("props")), F.lit(ADS)).alias("adId"),
        F.concat(F.lit("prov_"), F.pmod(uid, F.lit(7)).cast("string")).alias("province"),
        F.concat(F.lit("city_"), F.pmod(uid, F.lit(9)).cast("string")).alias("city"),
        F.col("ts"),
        F.col("event_id").alias("offset"),
    )
