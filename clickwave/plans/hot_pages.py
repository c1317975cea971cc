"""Hot pages: most requested GET pages per sliding window, and late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickwave.functions.formatting import PAGE_LABELS
from clickwave.functions.predicates import equals, not_static_resource
from clickwave.operators.lateness import split_late
from clickwave.operators.ranking import ranking_reports, top_n_by_count
from clickwave.operators.windows import sliding_counts

# Fixed values of the job: 10 min windows every 5 s, top 3, events up to 1 s
# out of order, windows revised for 1 min after they close.
SIZE, SLIDE, TOP = "10 minutes", "5 seconds", 3
OUT_OF_ORDERNESS, ALLOWED_LATENESS = "1 second", "1 minute"


def page_requests(log: DataFrame) -> DataFrame:
    """F1 + F3: GET requests of non-static pages."""
    return log.where(equals("method", "GET") & not_static_resource("url"))


def page_view_counts(log: DataFrame, size=SIZE, slide=SLIDE, method: str = "pane") -> DataFrame:
    return sliding_counts(page_requests(log).select("url", "ts"), ["url"], "ts", size, slide, method=method)


def hot_pages(log: DataFrame, top: int = TOP, size=SIZE, slide=SLIDE, method: str = "pane") -> DataFrame:
    """T2 (final state): top pages per window -> url, window_end, cnt, rank."""
    return top_n_by_count(page_view_counts(log, size, slide, method), "window_end", "url", "cnt", top)


def hot_pages_report(log: DataFrame, top: int = TOP, size=SIZE, slide=SLIDE) -> DataFrame:
    return ranking_reports(hot_pages(log, top, size, slide), "window_end", "url", "cnt", "rank", PAGE_LABELS)


def late_rows(log: DataFrame, source: str, arrival: str, tiebreak: str, size=SIZE, slide=SLIDE,
              lateness=ALLOWED_LATENESS, out_of_orderness=OUT_OF_ORDERNESS) -> DataFrame:
    """R2 + R4: page requests tagged ``is_late`` as they meet the watermark in
    arrival order per source partition.  Every row of the log moves the
    watermark; requests are picked afterwards."""
    return page_requests(split_late(log, source, arrival, tiebreak, "ts", size, slide,
                                    lateness, out_of_orderness))
