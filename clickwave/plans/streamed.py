"""Streaming forms of registered queries.

Each runs a Structured Streaming query over the driver's table (file source,
``availableNow``) into a parquet sink or ``foreachBatch`` tables under the
shared checkpoint folder, then returns the committed result as a DataFrame.
The table is all there is, so windows that are open when it ends are read from
the query's state and added (R11): the results are those of the batch jobs.
The table may be a file or a folder of part files; without a limit per trigger
it is one micro-batch.  The tests feed many.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwave.operators.fraud import reset_day
from clickwave.operators.timeutil import plus_seconds
from clickwave.session import checkpoint_dir
from clickwave.sources.events import (
    ad_clicks_from_events, marketing_from_events, user_behavior_from_events, web_log_lines_from_events,
)
from clickwave.sources.text import web_log_from_lines
from clickwave.streaming import jobs
from clickwave.streaming.bounded import open_counts, open_page_lists, open_runs
from clickwave.streaming.sinks import (
    LateSplitWriter, PageRankingWriter, RunningUvWriter, SlidingWindowWriter, SqlTopNWriter, TopNWriter, final_rankings,
    start_query,
)
from clickwave.streaming.sources import event_table_stream


def _workdir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/registered/{name}-{uuid.uuid4().hex[:12]}"


def _await(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_to_parquet(df: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Run an append-mode stream to completion into a parquet sink and read it back."""
    base = base or _workdir(df.sparkSession, name)
    q = start_query(df, name, "append", sink="parquet", path=f"{base}/out", checkpoint=f"{base}/ck")
    _await(q)
    try:
        return df.sparkSession.read.schema(df.schema).parquet(f"{base}/out")
    except AnalysisException:  # no micro-batch ran: nothing was written
        return df.sparkSession.createDataFrame([], df.schema)


def _and_open(emitted: DataFrame, left: DataFrame | None) -> DataFrame:
    return emitted if left is None else emitted.unionByName(left.select(*emitted.columns))


def _finish(writer, left: DataFrame | None) -> None:
    """Rank the windows left open as one more micro-batch."""
    if left is not None:
        writer(left, max(writer.out.epochs(), default=-1) + 1)


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


def hot_items_streamed(spark: SparkSession, sf_dir: str, page_view: str, top: int = 5) -> DataFrame:
    """Hot items on a stream: chained pane -> window counts (12 windows per
    pane, small enough to keep in state), ranked per micro-batch.  For long
    windows over short slides use pane state and ``SlidingWindowWriter(top=n)``."""
    behavior = user_behavior_from_events(event_table_stream(spark, sf_dir))
    base = _workdir(spark, "hot_items")
    writer = TopNWriter(spark, f"{base}/out", "window_end", "itemId", "cnt", top)
    q = start_query(jobs.hot_item_counts_stream(behavior, page_view=page_view), "hot_items", "append",
                    checkpoint=f"{base}/ck", foreach_batch=writer)
    _await(q)
    _finish(writer, open_counts(spark, f"{base}/ck", ["itemId", "window"]))
    return writer.result().select(F.col("itemId").alias("item_id"), _ntz("window_end"), "cnt", "rank")


def ad_click_capped_streamed(spark: SparkSession, sf_dir: str, cap: int) -> DataFrame:
    clicks = ad_clicks_from_events(event_table_stream(spark, sf_dir))
    out = run_to_parquet(jobs.capped_click_stream(clicks, cap), "ad_cap")
    ok = out.where(F.col("kind") == "ok")
    return ok.select(F.col("userId").alias("user_id"), F.col("adId").alias("ad_id"), "province", "city",
                     _ntz("ts"), F.col("offset").alias("event_id"), reset_day(F.col("ts")).alias("day"))


def ad_click_alerts_streamed(spark: SparkSession, sf_dir: str, cap: int) -> DataFrame:
    """R6 on a stream: one alert for each pair and day that goes over the cap."""
    clicks = ad_clicks_from_events(event_table_stream(spark, sf_dir))
    out = run_to_parquet(jobs.alert_stream(jobs.capped_click_stream(clicks, cap), cap), "ad_alerts")
    return out.select(F.col("userId").alias("user_id"), F.col("adId").alias("ad_id"),
                      reset_day(F.col("ts")).alias("day"), _ntz("ts"), "warning_msg")


def _uv_writer(spark: SparkSession, sf_dir: str, page_view: str) -> RunningUvWriter:
    behavior = user_behavior_from_events(event_table_stream(spark, sf_dir))
    base = _workdir(spark, "uv_running")
    writer = RunningUvWriter(spark, f"{base}/tables")
    q = start_query(jobs.bitmap_views_stream(behavior, page_view=page_view), "uv_running", "append",
                    checkpoint=f"{base}/ck", foreach_batch=writer)
    _await(q)
    return writer


def uv_running_streamed(spark: SparkSession, sf_dir: str, page_view: str) -> DataFrame:
    return _uv_writer(spark, sf_dir, page_view).result().select("key", _ntz("window_end"), _ntz("ts"), "uv_count")


def uv_count_streamed(spark: SparkSession, sf_dir: str, page_view: str) -> DataFrame:
    """The count table that the running UV stream keeps."""
    return _uv_writer(spark, sf_dir, page_view).uv_count().select(_ntz("window_end"), "uv")


def late_split_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_table_stream(spark, sf_dir)
    log = web_log_from_lines(web_log_lines_from_events(events), ntz=False)
    delay = F.pmod(F.col("offset") * F.lit(7919), F.lit(1800))
    log = (log.withColumn("source", F.pmod(F.col("user_id"), F.lit(4)))
           .withColumn("arrival", plus_seconds(F.col("ts"), delay)))
    base = _workdir(spark, "late_split")
    writer = LateSplitWriter(spark, base)
    _await(start_query(log, "late_split", "append", checkpoint=f"{base}/ck", foreach_batch=writer))
    return writer.result().select(F.col("offset").alias("event_id"), "source", "url", _ntz("ts"), _ntz("arrival"),
                      _ntz("watermark"), "is_late")


def pv_hourly_streamed(spark: SparkSession, sf_dir: str, page_view: str) -> DataFrame:
    behavior = user_behavior_from_events(event_table_stream(spark, sf_dir))
    base = _workdir(spark, "pv_hourly")
    out = run_to_parquet(jobs.page_views_stream(behavior, page_view=page_view), "pv_hourly", base)
    totals = open_counts(spark, f"{base}/ck", ["window"])
    if totals is not None:  # of windows that are open, and their parts that are
        parts = open_counts(spark, f"{base}/ck", ["salt", "window"], operator=1).drop("salt")
        left = totals.unionByName(parts).groupBy("window_end").agg(F.sum("cnt").alias("cnt"))
        out = _and_open(out, left.select(F.lit("pv").alias("key"), "*"))
    return out.select("key", _ntz("window_end"), "cnt")


def uv_hourly_streamed(spark: SparkSession, sf_dir: str, page_view: str) -> DataFrame:
    behavior = user_behavior_from_events(event_table_stream(spark, sf_dir))
    base = _workdir(spark, "uv_hourly")
    out = run_to_parquet(jobs.unique_visitors_stream(behavior, page_view=page_view), "uv_hourly", base)
    left = open_counts(spark, f"{base}/ck", ["window"])
    if left is not None:
        out = _and_open(out, left.select(F.lit("uv").alias("key"), "window_end", F.col("cnt").alias("uv")))
    return out.select("key", _ntz("window_end"), "uv")


def ads_by_province_streamed(spark: SparkSession, sf_dir: str, cap: int) -> DataFrame:
    clicks = ad_clicks_from_events(event_table_stream(spark, sf_dir))
    tagged = jobs.capped_click_stream(clicks, cap, delay="0 seconds")
    base = _workdir(spark, "ads_by_province")
    out = run_to_parquet(jobs.ads_by_province_stream(tagged), "ads_by_province", base).drop("window_end_text")
    out = _and_open(out, open_counts(spark, f"{base}/ck", ["province", "window"]))
    return out.select("province", _ntz("window_end"), "cnt")


def hot_pages_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rankings issued by the revising writer; the last issue of each window."""
    log = web_log_from_lines(web_log_lines_from_events(event_table_stream(spark, sf_dir)), ntz=False)
    base = _workdir(spark, "hot_pages")
    writer = PageRankingWriter(spark, f"{base}/tables")
    q = start_query(jobs.page_pane_updates(log), "hot_pages", "update", checkpoint=f"{base}/ck",
                    foreach_batch=writer)
    _await(q)
    _finish(writer, open_page_lists(spark, f"{base}/ck"))
    ranks = writer.rankings.read()
    if ranks is None:
        return spark.createDataFrame([], "url string, window_end timestamp_ntz, cnt bigint, rank int")
    return final_rankings(ranks).select("url", _ntz("window_end"), "cnt", "rank")


def _marketing(spark: SparkSession, sf_dir: str, uninstall: str, keys: list[str], output: str) -> DataFrame:
    events = marketing_from_events(event_table_stream(spark, sf_dir))
    base = _workdir(spark, "marketing")
    writer = SlidingWindowWriter(spark, f"{base}/tables", keys, "1 hour", "5 seconds", output=output)
    runs = jobs.marketing_pane_updates(events, by_channel=bool(keys), uninstall=uninstall, whole=output == "runs")
    _await(start_query(runs, "marketing", "update", checkpoint=f"{base}/ck", foreach_batch=writer))
    _finish(writer, open_runs(spark, f"{base}/ck", keys))
    return writer.result()


def marketing_total_streamed(spark: SparkSession, sf_dir: str, uninstall: str) -> DataFrame:
    """Marketing total on a stream, a row per window end."""
    return _marketing(spark, sf_dir, uninstall, [], "dense").select(
        F.lit("total").alias("channel"), F.lit("total").alias("behavior"), _ntz("window_end"), "cnt")


def marketing_by_channel_streamed(spark: SparkSession, sf_dir: str, uninstall: str) -> DataFrame:
    """Per (channel, behaviour) on a stream, as runs of window ends."""
    keys = ["channel", "behavior"]
    return _marketing(spark, sf_dir, uninstall, keys, "runs").select(
        *keys, _ntz("window_end_from"), _ntz("window_end_until"), "cnt")


def hot_items_sql_streamed(spark: SparkSession, sf_dir: str, page_view: str, top: int = 5) -> DataFrame:
    """R9 + T3 on a stream: the stream as a SQL view, window counts in SQL,
    and the reference's ROW_NUMBER statement on every micro-batch."""
    behavior = user_behavior_from_events(event_table_stream(spark, sf_dir))
    base = _workdir(spark, "hot_items_sql")
    writer = SqlTopNWriter(spark, f"{base}/out", top=top)
    agg = jobs.hot_items_sql_stream(spark, behavior, page_view=page_view)
    q = start_query(agg, "hot_items_sql", "append", checkpoint=f"{base}/ck", foreach_batch=writer)
    _await(q)
    left = open_counts(spark, f"{base}/ck", ["window", "itemId"])
    _finish(writer, None if left is None else left.select("itemId", "cnt", F.col("window_end").alias("windowEnd")))
    return writer.result().select(F.col("itemId").alias("item_id"), "cnt", _ntz("windowEnd").alias("window_end"),
                                  "row_num")
