"""Hot items: most viewed items per sliding window (DataFrame and SQL forms)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwave.functions.formatting import ITEM_LABELS
from clickwave.functions.predicates import equals
from clickwave.operators.timeutil import seconds
from clickwave.operators.ranking import ranking_reports, top_n_by_count
from clickwave.operators.windows import sliding_counts

PAGE_VIEW = "pv"


def item_view_counts(behavior: DataFrame, size="1 hour", slide="5 minutes",
                     page_view: str = PAGE_VIEW, method: str = "pane") -> DataFrame:
    """F1 -> W2 -> A1: views per (itemId, window_end) -> itemId, window_end, cnt."""
    views = behavior.where(equals("behavior", page_view)).select("itemId", "ts")
    return sliding_counts(views, ["itemId"], "ts", size, slide, method=method)


def hot_items(behavior: DataFrame, top: int = 5, size="1 hour", slide="5 minutes",
              page_view: str = PAGE_VIEW, method: str = "pane") -> DataFrame:
    """The ``top`` most viewed items per window -> itemId, window_end, cnt, rank."""
    counts = item_view_counts(behavior, size, slide, page_view, method)
    return top_n_by_count(counts, "window_end", "itemId", "cnt", top)


def hot_items_report(behavior: DataFrame, top: int = 5, size="1 hour", slide="5 minutes",
                     page_view: str = PAGE_VIEW) -> DataFrame:
    """The ranking as one text block per window -> window_end, report."""
    ranked = hot_items(behavior, top, size, slide, page_view)
    return ranking_reports(ranked, "window_end", "itemId", "cnt", "rank", ITEM_LABELS)


def hot_items_table_api(behavior: DataFrame, size="1 hour", slide="5 minutes",
                        page_view: str = PAGE_VIEW) -> DataFrame:
    """W4 + A2: the Table-API aggregate ``itemId, w.end as windowEnd, itemId.count as cnt``."""
    rows = behavior.select("itemId", "behavior", "ts").where(equals("behavior", page_view))
    counts = sliding_counts(rows, ["itemId"], "ts", size, slide, count_col="itemId")
    return counts.select("itemId", F.col("window_end").alias("windowEnd"), "cnt")


# Views per pane first, so that raw rows are never copied; then every pane is
# spread over the windows that hold it, and windows are ranked.
RANKING_SQL = """
WITH panes AS (
  SELECT itemId AS item, window(ts, '{slide} seconds').end AS pane_end, count(itemId) AS views
  FROM {view} WHERE behavior = '{page_view}' GROUP BY ALL
), spread AS (
  SELECT item, views, explode(sequence(pane_end, pane_end + INTERVAL '{reach}' SECOND, INTERVAL '{slide}' SECOND)) AS closes
  FROM panes
), totals AS (
  SELECT closes, item, sum(views) AS views FROM spread GROUP BY closes, item
), places AS (
  SELECT totals.*, row_number() OVER (PARTITION BY closes ORDER BY views DESC, item) AS place FROM totals
)
SELECT item AS itemId, views AS cnt, closes AS windowEnd, place AS row_num FROM places WHERE place <= {top}
"""


def hot_items_sql(spark: SparkSession, behavior: DataFrame, top: int = 5, size="1 hour",
                  slide="5 minutes", page_view: str = PAGE_VIEW) -> DataFrame:
    """R9 + W5 + T3 + F4: the same ranking through a temp view and Spark SQL.
    The view has a name of its own and is gone when the query is planned."""
    size_s, slide_s = seconds(size), seconds(slide)
    if size_s % slide_s:
        raise ValueError("the size must be a multiple of the slide")
    view = f"clickwave_views_{uuid.uuid4().hex}"
    behavior.select("itemId", "behavior", "ts").createOrReplaceTempView(view)
    try:
        return spark.sql(RANKING_SQL.format(view=view, page_view=page_view, slide=slide_s,
                                            reach=size_s - slide_s, top=int(top)))
    finally:
        spark.catalog.dropTempView(view)
