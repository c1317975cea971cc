"""Late-row diversion for sliding windows with allowed lateness (R2-R4), batch form.

Rows reach the window operator in arrival order per source partition.  The
watermark a row meets is the largest event time seen before it in its
partition minus the out-of-orderness bound.  A row goes to the late side
output when every window it belongs to is past ``end - 1 ms + lateness``;
it suffices to test the last such window, the one ending at
``pane_end + size - slide``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwave.operators.scan import running_aggregate
from clickwave.operators.timeutil import plus_seconds, seconds
from clickwave.operators.windows import window_end


def split_late(df: DataFrame, source: str, arrival: str, tiebreak: str, ts: str,
               size, slide, lateness, out_of_orderness,
               bucket_seconds: int | None = None) -> DataFrame:
    """Add ``watermark`` and ``is_late`` to every row."""
    size_s, slide_s = seconds(size), seconds(slide)
    lateness_s, ooo_s = seconds(lateness), seconds(out_of_orderness)
    seen = running_aggregate(df, [source], [arrival, tiebreak], how="max", value=ts,
                             out="_seen_max", inclusive=False, bucket_seconds=bucket_seconds)
    last_end = plus_seconds(window_end(F.col(ts), slide_s), size_s - slide_s)
    cleanup = plus_seconds(last_end, lateness_s) - F.expr("INTERVAL '0.001' SECOND")
    wm = plus_seconds(F.col("_seen_max"), -ooo_s)
    return (seen.withColumn("watermark", wm)
            .withColumn("is_late", F.coalesce(cleanup <= F.col("watermark"), F.lit(False)))
            .drop("_seen_max"))
