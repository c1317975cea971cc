"""Sinks and ``foreachBatch`` writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickwave.functions.predicates import equals, not_static_resource
from clickwave.operators.ranking import top_n_by_count
from clickwave.operators.windows import expand_runs
from clickwave.operators.scan import running_aggregate
from clickwave.operators.timeutil import plus_seconds, seconds
from clickwave.session import streaming_checkpoint
from clickwave.streaming.tables import AppendLog


def start_query(df: DataFrame, name: str, output_mode: str = "append", sink: str = "memory",
                path: str | None = None, trigger: dict | None = None,
                checkpoint: str | None = None, foreach_batch=None) -> StreamingQuery:
    """Start a labelled streaming query (memory/console/parquet or foreachBatch).

    The checkpoint goes under the shared ``spark.checkpoint.dir`` unless given.
    """
    w = (df.writeStream.queryName(name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or streaming_checkpoint(df.sparkSession, f"{name}-{uuid.uuid4().hex[:8]}")))
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
    return w.trigger(**(trigger or {"availableNow": True})).start()


class SlidingWindowWriter:
    """Writes final sliding-window counts (``sliding_runs_stream``) as runs, or
    as dense rows, optionally ranked per window (T1 on streams): the watermark
    closes a window for all keys in one micro-batch, so its ranking is final."""

    def __init__(self, spark: SparkSession, base: str, keys: list[str], size, slide,
                 output: str = "dense", top: int | None = None, rank_col: str = "rank"):
        if output not in ("dense", "runs"):
            raise ValueError("output is 'dense' or 'runs'")
        if top is not None and (output != "dense" or len(keys) != 1):
            raise ValueError("ranking needs dense output over one key")
        self.keys, self.slide_s, self.output, self.top, self.rank_col = list(keys), seconds(slide), output, top, rank_col
        self.out = AppendLog(spark, f"{base.rstrip('/')}/windows")

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        rows = batch
        if self.output == "dense":
            rows = expand_runs(batch, self.slide_s).select(*self.keys, "window_end", "cnt")
            if self.top is not None:
                rows = top_n_by_count(rows, "window_end", self.keys[0], "cnt", self.top, self.rank_col)
        self.out.write(rows, epoch)

    def result(self) -> DataFrame:
        return self.out.read_all()


class TopNWriter:
    """Final per-window rankings from an append-mode count stream (T1 on streams).

    Each micro-batch holds whole windows, so ``row_number`` over the batch is
    final; its partial window-group limit keeps the work per window bounded.
    """

    def __init__(self, spark: SparkSession, base: str, window_col: str, key: str, cnt: str,
                 n: int, rank_col: str = "rank"):
        self.out = AppendLog(spark, base)
        self.args = (window_col, key, cnt, n, rank_col)

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        window_col, key, cnt, n, rank_col = self.args
        self.out.write(top_n_by_count(batch, window_col, key, cnt, n, rank_col), epoch)

    def result(self) -> DataFrame:
        return self.out.read_all()


class SqlTopNWriter:
    """R9 + T3: each micro-batch of an append-mode window aggregate is ranked
    in SQL, through a view of its own."""

    SQL = """
    WITH places AS (
      SELECT counted.*, row_number() OVER (PARTITION BY windowEnd ORDER BY cnt DESC, itemId) AS row_num
      FROM {view} AS counted
    )
    SELECT * FROM places WHERE row_num <= {top}
    """

    def __init__(self, spark: SparkSession, base: str, top: int = 5):
        self.out = AppendLog(spark, base)
        self.top = top

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        view = f"clickwave_counts_{uuid.uuid4().hex}"
        batch.createOrReplaceTempView(view)
        try:
            self.out.write(batch.sparkSession.sql(self.SQL.format(view=view, top=int(self.top))), epoch)
        finally:
            batch.sparkSession.catalog.dropTempView(view)

    def result(self) -> DataFrame:
        return self.out.read_all()


class RunningUvWriter:
    """A8 + S7 on a stream of first sightings (``bitmap_views_stream``).

    Per micro-batch the new visitors of a window are ranked in arrival order
    (bucketed scan) on top of its number before, the sum over its salts; one
    row each.  The count table of the windows (``uv_count``) gets the new
    number of each window; as it only grows, the largest is the latest.
    """

    def __init__(self, spark: SparkSession, base: str, bucket_seconds: int | None = None):
        self.spark = spark
        base = base.rstrip("/")
        self.counts = AppendLog(spark, f"{base}/uv_count")
        self.rows = AppendLog(spark, f"{base}/rows")
        self.bucket_seconds = bucket_seconds

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            before = (batch.where(F.col("before").isNotNull()).groupBy(F.col("window_end").alias("_w"))
                      .agg(F.sum("before").alias("_before")))
            firsts = batch.where(F.col("before").isNull()).drop("before")
            ranked = running_aggregate(firsts, ["window_end"], ["ts", "offset", "off"], "count", "_n",
                                       bucket_seconds=self.bucket_seconds)
            rows = (ranked.join(before, F.col("window_end") == F.col("_w"))
                    .select(F.lit("uv").alias("key"), "window_end", "ts", (F.col("_before") + F.col("_n")).alias("uv_count")))
            self.rows.write(rows, epoch)
            added = firsts.groupBy("window_end").agg(F.count(F.lit(1)).alias("_n"))
            self.counts.write(added.join(before, F.col("window_end") == F.col("_w"))
                              .select("window_end", (F.col("_before") + F.col("_n")).alias("uv")), epoch)
        finally:
            batch.unpersist()

    def result(self) -> DataFrame:
        got = self.rows.read()
        if got is None:
            return self.spark.createDataFrame([], "key string, window_end timestamp, ts timestamp, uv_count bigint")
        return got.select("key", "window_end", "ts", "uv_count")

    def uv_count(self) -> DataFrame:
        """The count table, one row per window."""
        got = self.counts.read()
        if got is None:
            return self.spark.createDataFrame([], "window_end timestamp, uv bigint")
        return got.groupBy("window_end").agg(F.max("uv").alias("uv"))


class LateSplitWriter:
    """R2 + R4 on a stream of log rows with ``source``, ``arrival`` and
    ``offset`` columns: the page requests among them with ``watermark`` and
    ``is_late``.

    Per micro-batch the running maximum of the event time is the bucketed
    scan of the batch job, so a source is never gathered in one task; the
    largest time of each source goes into the next micro-batch as a table of
    one row per source.  Every row moves the watermark, requests are picked
    afterwards; rows without a time are rejects.
    """

    def __init__(self, spark: SparkSession, base: str, source: str = "source", size="10 minutes",
                 slide="5 seconds", lateness="1 minute", out_of_orderness="1 second",
                 rows_per_bucket: int = 1_000_000):
        self.spark, self.base, self.source = spark, base.rstrip("/"), source
        self.times = (seconds(size), seconds(slide), seconds(lateness), seconds(out_of_orderness))
        self.rows_per_bucket = rows_per_bucket
        self.out = AppendLog(spark, f"{self.base}/rows")

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        size_s, slide_s, lateness_s, ooo_s = self.times
        batch = batch.where(F.col("ts").isNotNull())
        kind = batch.schema[self.source].dataType.simpleString()
        before = (self.spark.read.parquet(f"{self.base}/seen/epoch={epoch - 1}") if epoch
                  else self.spark.createDataFrame([], f"_source {kind}, _top timestamp"))
        seen = running_aggregate(batch, [self.source], ["arrival", "offset"], how="max", value="ts", out="_seen",
                                 inclusive=False, rows_per_bucket=self.rows_per_bucket)
        last_end = plus_seconds(F.window("ts", f"{slide_s} seconds").end, size_s - slide_s)
        cleanup = plus_seconds(last_end, lateness_s) - F.expr("INTERVAL '0.001' SECOND")
        tagged = (seen.join(before, F.col(self.source).eqNullSafe(F.col("_source")), "left")
                  .withColumn("watermark", plus_seconds(F.greatest("_seen", "_top"), -ooo_s))
                  .withColumn("is_late", F.coalesce(cleanup <= F.col("watermark"), F.lit(False))))
        self.out.write(tagged.where(equals("method", "GET") & not_static_resource("url"))
                       .drop("_seen", "_source", "_top"), epoch)
        now = batch.select(F.col(self.source).alias("_source"), F.col("ts").alias("_top")).unionByName(before)
        now.groupBy("_source").agg(F.max("_top").alias("_top")).write.mode("overwrite").parquet(
            f"{self.base}/seen/epoch={epoch}")

    def result(self) -> DataFrame:
        return self.out.read_all()


class PageRankingWriter:
    """T2 + R3 + R10: page rankings issued when the watermark passes a window's
    end and issued again when late rows come for it, until the window is
    ``lateness`` past its end (``page_pane_updates``).

    A micro-batch holds the lists of all salts of every window it issues, and
    the lists of its last issue; both are merged by rank.  Output: every issued
    ranking (``rankings``) and its difference from the previous issue of the
    same window (``changes``, op ``+``/``-``).  A micro-batch has two epochs of
    output: windows the watermark has passed, then those revised by its rows.
    """

    def __init__(self, spark: SparkSession, base: str, top: int = 3):
        self.top = top
        self.rankings = AppendLog(spark, f"{base}/rankings")
        self.changes = AppendLog(spark, f"{base}/changes")
        self.out = self.rankings

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            for revised in (False, True):
                lists = batch.where(F.col("revised") == F.lit(revised))
                if lists.isEmpty():
                    continue
                merged = lambda was: top_n_by_count(
                    lists.where(F.col("was") == F.lit(was)).drop("was", "revised"), "window_end", "url", "cnt", self.top)
                now, at = merged(False).persist(), 2 * epoch + revised
                self.rankings.write(now, at)
                added = now.withColumn("op", F.lit("+"))
                if revised:  # a first issue has nothing before it
                    before = merged(True)
                    added = (now.exceptAll(before).withColumn("op", F.lit("+"))
                             .unionByName(before.exceptAll(now).withColumn("op", F.lit("-"))))
                self.changes.write(added, at)
                now.unpersist()
        finally:
            batch.unpersist()


def final_rankings(rankings: DataFrame) -> DataFrame:
    """The last issue of every window from a ``PageRankingWriter.rankings`` log."""
    last = rankings.groupBy("window_end").agg(F.max("epoch").alias("epoch"))
    return rankings.join(last, ["window_end", "epoch"], "left_semi").drop("epoch")
