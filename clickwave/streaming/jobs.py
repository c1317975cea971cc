"""Streaming jobs (R1-R11 with the batch operators' semantics)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwave.functions.formatting import alert_message, java_timestamp_text
from clickwave.functions.hashing import bitmap_offset
from clickwave.functions.predicates import equals, not_equal_keep_null, not_static_resource
from clickwave.operators.fraud import RESET_OFFSET_HOURS
from clickwave.operators.timeutil import seconds
from clickwave.streaming.combine import combined, dealt, packed
from clickwave.streaming.processors import (
    DAY_MS, ClickCapProcessor, ClickCapRowProcessor, NewVisitorProcessor, PageRankingProcessor, SlidingRunsProcessor,
)
from clickwave.streaming.sources import rows_where, with_event_time

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _win(ts: str | Column, size, slide=None) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    if slide is None:
        return F.window(ts, f"{seconds(size)} seconds")
    return F.window(ts, f"{seconds(size)} seconds", f"{seconds(slide)} seconds")


def stream_sliding_counts(df: DataFrame, keys: list[str], ts: str, size, slide,
                          out: str = "cnt") -> DataFrame:
    """Sliding-window counts on a stream, append mode.  -> keys, window, out.

    Spark keeps ``size/slide`` rows of state per key and pane and checks every
    window of a row against the watermark, so a late row counts in the windows
    that are still open.  Where ``size/slide`` is large, keep panes instead
    (:func:`sliding_runs_stream`).
    """
    return df.groupBy(*keys, _win(ts, size, slide)).agg(F.count(F.lit(1)).alias(out))


def hot_item_counts_stream(behavior: DataFrame, size="1 hour", slide="5 minutes",
                           page_view: str = "pv", delay: str = "0 seconds") -> DataFrame:
    """Item view counts per sliding window on a stream -> itemId, window_end, cnt (append).

    In append mode a window's rows leave the state store together, in the
    micro-batch whose watermark passes its end, so ranking each micro-batch
    (:class:`clickwave.streaming.sinks.TopNWriter`) gives final rankings
    with bounded work per window.
    """
    views = rows_where(with_event_time(behavior, delay), equals("behavior", page_view)).select("itemId", "ts")
    counts = stream_sliding_counts(views, ["itemId"], "ts", size, slide)
    return counts.select("itemId", F.col("window.end").alias("window_end"), "cnt")


VIEWS_PER_WINDOW_SQL = """
SELECT item AS itemId, count(*) AS cnt, hop.end AS windowEnd
FROM (SELECT itemId AS item, window(ts, '{size} seconds', '{slide} seconds') AS hop
      FROM {view} WHERE CASE WHEN behavior = '{page_view}' THEN ts END = ts)
GROUP BY hop, item
"""


def hot_items_sql_stream(spark: SparkSession, behavior: DataFrame, size="1 hour", slide="5 minutes",
                         page_view: str = "pv", delay: str = "0 seconds") -> DataFrame:
    """A stream registered as a view and aggregated with SQL (append).
    ``ROW_NUMBER`` is refused on streams; rank each micro-batch with
    :class:`clickwave.streaming.sinks.SqlTopNWriter`.  The filter is on the
    event time, so that every row moves it (see ``rows_where``)."""
    view = f"clickwave_stream_{uuid.uuid4().hex}"
    with_event_time(behavior, delay).select("itemId", "behavior", "ts").createOrReplaceTempView(view)
    try:
        return spark.sql(VIEWS_PER_WINDOW_SQL.format(view=view, page_view=page_view, size=seconds(size),
                                                     slide=seconds(slide)))
    finally:
        spark.catalog.dropTempView(view)


def page_views_stream(behavior: DataFrame, size="1 hour", salts: int = 10, page_view: str = "pv",
                      delay: str = "0 seconds") -> DataFrame:
    """Page views per hour on a stream, salted two-phase count -> key, window_end, cnt."""
    views = rows_where(with_event_time(behavior, delay), equals("behavior", page_view))
    cols = ["offset"] if "offset" in views.columns else ["ts", "userId"]
    salted = views.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(salts)))
    part = salted.groupBy("_salt", _win("ts", size).alias("window")).agg(F.count(F.lit(1)).alias("_c"))
    total = part.groupBy("window").agg(F.sum("_c").alias("cnt"))
    return total.select(F.lit("pv").alias("key"), F.col("window.end").alias("window_end"), "cnt")


def unique_visitors_stream(behavior: DataFrame, size="1 hour", page_view: str = "pv",
                           delay: str = "0 seconds") -> DataFrame:
    """Unique visitors per hour on a stream: dedup (window, user) in the state store, then count."""
    views = rows_where(with_event_time(behavior, delay), equals("behavior", page_view))
    firsts = views.select(_win("ts", size).alias("window"), "userId").dropDuplicates(["window", "userId"])
    return (firsts.groupBy("window").agg(F.count(F.lit(1)).alias("uv"))
            .select(F.lit("uv").alias("key"), F.col("window.end").alias("window_end"), "uv"))


def bitmap_views_stream(behavior: DataFrame, size="1 hour", page_view: str = "pv", salts: int = 4,
                        delay: str = "0 seconds") -> DataFrame:
    """A8 input -> window_end, off, ts, offset, before: the first view of every
    (window, bitmap offset), and per window and salt the number of offsets seen
    before this micro-batch (:class:`NewVisitorProcessor`)."""
    _use_rocksdb(behavior.sparkSession)
    size_s = seconds(size)
    off = F.col("offset") if "offset" in behavior.columns else F.lit(0).cast("bigint")
    rows = behavior.select(F.unix_seconds(_win("ts", size).end).alias("window_end"), bitmap_offset(F.col("userId")).alias("off"),
                           F.col("ts").alias("first_ts"), off.alias("offset"), "behavior", "ts")
    firsts = combined(rows, ["window_end", "off"], "ts", equals("behavior", page_view), first=("first_ts", "offset"))
    views = with_event_time(dealt(firsts, "window_end", "off", "ts", salts), _wider(delay, size_s))
    new = (rows_where(views, (F.col("n") > 0) | F.col("mark")).groupBy("window_end", "salt")
           .transformWithState(NewVisitorProcessor(size_s), "window_end long, off long, ts timestamp, offset long, before long",
                               "Append", "EventTime"))
    return new.withColumn("window_end", F.timestamp_seconds("window_end"))


def marketing_stream(events: DataFrame, by_channel: bool = True, size="1 hour", slide="5 seconds",
                     uninstall: str = "UNINSTALL", delay: str = "0 seconds") -> DataFrame:
    """Marketing counts per channel and behaviour, or in total, on a stream
    -> channel, behavior, window_end, window_end_text, cnt."""
    kept = rows_where(with_event_time(events, delay), not_equal_keep_null("behavior", uninstall))
    keys = ["channel", "behavior"] if by_channel else []
    counts = stream_sliding_counts(kept.select(*keys, "ts"), keys, "ts", size, slide)
    if not by_channel:
        counts = counts.select(F.lit("total").alias("channel"), F.lit("total").alias("behavior"), "*")
    return counts.select("channel", "behavior", F.col("window.end").alias("window_end"),
                         java_timestamp_text(F.col("window.end")).alias("window_end_text"), "cnt")


CAPPED_FIELDS = [
    T.StructField("userId", T.LongType()), T.StructField("adId", T.LongType()),
    T.StructField("province", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("ts", T.TimestampType()), T.StructField("offset", T.LongType()),
    T.StructField("_day_end", T.LongType()), T.StructField("kind", T.StringType()),
]


#: States that the keys of a day are dealt into, and the last event time a
#: processor can be given (pandas counts nanoseconds).
CAP_BUCKETS, LAST_TIME = 64, "2262-01-01"


def capped_click_stream(clicks: DataFrame, cap: int = 100, keys=("userId", "adId"),
                        delay: str = "1 day", offset_hours: int = RESET_OFFSET_HOURS,
                        form: str = "pandas", buckets: int = CAP_BUCKETS) -> DataFrame:
    """The click cap on a stream: rows tagged ``ok`` / ``alert`` by a stateful
    processor keyed by ``keys`` and reset day, so that a late click counts in
    its own day, whatever day came meanwhile.  A day's state goes when the
    watermark passes its end; a click later than ``delay`` is dropped.  Clicks
    without a time are rejects, not part of any day: see ``split_rejects``.

    ``form="pandas"`` (``transformWithStateInPandas``) deals the keys of a day
    into ``buckets``, each with one state, and suits any number of keys;
    ``form="rows"`` (``transformWithState``) keeps a state, a timer and an
    output batch for each key and day, about a millisecond each, and suits few
    keys.
    """
    _use_rocksdb(clicks.sparkSession)
    off = offset_hours * 3_600_000
    if "offset" not in clicks.columns:
        clicks = clicks.withColumn("offset", F.lit(0).cast("bigint"))
    day_end = (F.floor((F.unix_millis(F.col("ts")) + F.lit(off)) / F.lit(DAY_MS)) + 1) * F.lit(DAY_MS) - F.lit(off)
    names = [f.name for f in CAPPED_FIELDS[:7]]
    if form == "rows":
        src = with_event_time(clicks, delay)
        rows = src.where(F.col("ts").isNotNull()).withColumn("_day_end", day_end.cast("bigint")).select(*names)
        return rows.groupBy(*keys, "_day_end").transformWithState(
            ClickCapRowProcessor(cap), T.StructType(CAPPED_FIELDS), "Append", "EventTime", eventTimeColumnName="ts")
    # pandas has no integers beside nulls: a bit of _nulls stands for each null, 0 for the number
    longs = ["userId", "adId", "offset"]
    nulls = sum((F.col(c).isNull().cast("int") * F.lit(1 << k) for k, c in enumerate(longs)), F.lit(0))
    src = with_event_time(clicks.withColumn("_time", F.least("ts", F.lit(LAST_TIME).cast("timestamp"))), delay, "_time")
    rows = (src.where(F.col("ts").isNotNull())
            .select("_time", F.unix_micros("ts").alias("_us"), day_end.cast("bigint").alias("_day_end"), nulls.alias("_nulls"),
                    F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket"),
                    *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) if c in longs else F.col(c) for c in names if c not in ("ts", "_day_end")],
                    *[F.col(c).isNull().alias(f"_no_{c}") for c in keys]))
    out = rows.groupBy("_bucket", "_day_end").transformWithStateInPandas(
        ClickCapProcessor(cap, (*keys, *(f"_no_{c}" for c in keys)), rows.columns),
        T.StructType([*CAPPED_FIELDS, T.StructField("_nulls", T.IntegerType())]), "Append", "EventTime", eventTimeColumnName="ts")
    bit = {c: F.col("_nulls").bitwiseAND(1 << k) for k, c in enumerate(longs)}
    return out.select(*[F.when(bit[f.name] == 0, F.col(f.name)).alias(f.name) if f.name in bit else f.name for f in CAPPED_FIELDS])


def ads_by_province_stream(tagged: DataFrame, size="1 hour", slide="5 minutes") -> DataFrame:
    ok = tagged.where(F.col("kind") == "ok").select("province", "ts")
    counts = stream_sliding_counts(ok, ["province"], "ts", size, slide)
    return counts.select("province", F.col("window.end").alias("window_end"),
                         java_timestamp_text(F.col("window.end")).alias("window_end_text"), "cnt")


def alert_stream(tagged: DataFrame, cap: int = 100) -> DataFrame:
    return tagged.where(F.col("kind") == "alert").select("userId", "adId", "ts", alert_message(cap).alias("warning_msg"))


def _use_rocksdb(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _wider(delay, more_s: int) -> str:
    """A watermark delay that lets rows in that are late for some windows; the
    processors know the job's own delay."""
    return f"{seconds(delay) + more_s} seconds"


#: Window ends whose pages share a state, at least this long.
PAGE_BLOCK_SECONDS = 3600


def page_pane_updates(log: DataFrame, size="10 minutes", slide="5 seconds", lateness="1 minute",
                      out_of_orderness="1 second", top: int = 3, salts: int = 2) -> DataFrame:
    """The ``top`` pages of every window the watermark has passed, per salt and
    micro-batch (R2, R3) -> window_end, url, cnt, was, revised, in update mode.

    Requests are counted per (page, pane) in the map tasks; a pane's count goes
    to the one or two blocks of window ends that it is in, and a block's pages
    are spread over ``salts`` states (:class:`PageRankingProcessor`);
    :class:`clickwave.streaming.sinks.PageRankingWriter` merges them."""
    _use_rocksdb(log.sparkSession)
    size_s, slide_s, lateness_s = seconds(size), seconds(slide), seconds(lateness)
    if size_s % slide_s:
        raise ValueError("panes need a size that is a multiple of the slide")
    block = max(size_s, -(-PAGE_BLOCK_SECONDS // slide_s) * slide_s)
    rows = log.select("url", F.unix_seconds(_win("ts", slide).end).alias("pane_end"), "method", "ts")
    parts = combined(rows, ["url", "pane_end"], "ts", equals("method", "GET") & not_static_resource("url"))
    parts = dealt(parts, "pane_end", "url", "ts", salts)
    last = F.col("pane_end") + (size_s - slide_s)
    at = lambda e: F.floor((e - slide_s) / block)
    spread = (parts.withColumn("block", F.explode_outer(F.sequence(at(F.col("pane_end")), at(last))))
              .select("block", "salt", "url", "mark", "n", "ts",
                      F.greatest(F.col("pane_end"), F.col("block") * block + slide_s).alias("low"),
                      (F.least(last, (F.col("block") + 1) * block) + slide_s).alias("until")))
    lists = with_event_time(packed(spread, ["block", "salt"], ["url", "mark", "low", "until", "n"], "ts"),
                            _wider(out_of_orderness, lateness_s + size_s - slide_s))
    issued = rows_where(lists, F.col("block").isNotNull()).groupBy("block", "salt").transformWithState(
        PageRankingProcessor(top, block, size_s, slide_s, lateness_s), "issued string", "Update", "EventTime")
    page = F.explode(F.from_json("issued", "array<struct<end: long, url: string, cnt: long, was: boolean, revised: boolean>>"))
    return issued.select(page.alias("p")).select(F.timestamp_seconds("p.end").alias("window_end"), "p.url", "p.cnt", "p.was", "p.revised")


def sliding_runs_stream(df: DataFrame, keys: list[str], keep: Column, size="1 hour", slide="5 seconds",
                        delay: str = "0 seconds", whole: bool = False, mode: str = "Append") -> DataFrame:
    """Final sliding-window counts of the rows with ``keep`` as runs of window
    ends -> keys, window_end_from, window_end_until, cnt.

    Panes are counted in the map tasks, and the state of a key is its count as
    a step function over the window ends still open
    (:class:`SlidingRunsProcessor`), however long the window is in slides.
    ``whole`` runs come when they are over, others as far as they are final.
    """
    _use_rocksdb(df.sparkSession)
    size_s, slide_s = seconds(size), seconds(slide)
    if size_s % slide_s:
        raise ValueError("panes need a size that is a multiple of the slide")
    rows = df.withColumn("pane_end", F.unix_seconds(_win("ts", slide).end))
    parts = with_event_time(combined(rows, [*keys, "pane_end"], "ts", keep), _wider(delay, size_s - slide_s))
    parts, by = rows_where(parts, F.col("n") > 0), list(keys)
    if not keys:
        parts, by = parts.withColumn("_all", F.lit(0)), ["_all"]
    schema = T.StructType([*(parts.schema[k] for k in by), T.StructField("window_end_from", T.LongType()),
                           T.StructField("window_end_until", T.LongType()), T.StructField("cnt", T.LongType())])
    runs = parts.groupBy(*by).transformWithState(SlidingRunsProcessor(by, size_s, slide_s, whole), schema, mode, "EventTime")
    return runs_from_seconds(runs, keys)


def runs_from_seconds(runs: DataFrame, keys: list[str]) -> DataFrame:
    return runs.select(*keys, F.timestamp_seconds("window_end_from").alias("window_end_from"),
                       F.timestamp_seconds("window_end_until").alias("window_end_until"), "cnt")


def marketing_pane_updates(events: DataFrame, by_channel: bool = True, size="1 hour", slide="5 seconds",
                           uninstall: str = "UNINSTALL", delay: str = "0 seconds", whole: bool = False) -> DataFrame:
    """Marketing counts as runs of window ends, in update mode, for ``SlidingWindowWriter``."""
    keys = ["channel", "behavior"] if by_channel else []
    return sliding_runs_stream(events, keys, not_equal_keep_null("behavior", uninstall), size, slide, delay, whole, "Update")


def item_view_pane_updates(behavior: DataFrame, size="1 hour", slide="5 minutes", page_view: str = "pv",
                           delay: str = "0 seconds") -> DataFrame:
    """Item views as runs of window ends, in update mode, for ``SlidingWindowWriter(top=n)``."""
    return sliding_runs_stream(behavior, ["itemId"], equals("behavior", page_view), size, slide, delay, mode="Update")
