"""Output formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of a ranking report.  A block reads
#   =====================窗口结束时间：2017-11-26 09:05:00.0
#   NO 1: 商品ID=7热门度=3
#   =====================
REPORT_RULE = "====================="
REPORT_WINDOW_LABEL = "窗口结束时间："
ITEM_LABELS = ("商品ID=", "热门度=")
PAGE_LABELS = ("页面URL=", "浏览量=")

# Fixed value: alert text, no space before the number.
ALERT_TEMPLATE = "click over%d times"


def epoch_millis(ts: Column) -> Column:
    """Event time -> epoch milliseconds (``Long`` window ends)."""
    return F.unix_millis(ts.cast("timestamp"))


def java_timestamp_text(ts: Column) -> Column:
    """P10: ``java.sql.Timestamp.toString`` of a whole-second instant, e.g.
    ``2017-11-26 09:05:00.0`` (session zone)."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.S")


def alert_message(cap: int) -> Column:
    """Blacklist warning text."""
    return F.lit(ALERT_TEMPLATE % cap)


def ranking_report(window_end: Column, entries: Column,
                   labels: tuple[str, str] = ITEM_LABELS) -> Column:
    """One text block from ``entries`` = array<struct<rank, key, cnt>>.

    The array is sorted by rank here, so callers may pass an unordered
    ``collect_list``.
    """
    key_label, cnt_label = labels
    ordered = F.array_sort(entries, lambda a, b: (a["rank"] - b["rank"]).cast("int"))
    lines = F.transform(
        ordered,
        lambda e: F.format_string(f"NO %d: {key_label}%s{cnt_label}%d\n",
                                  e["rank"], e["key"].cast("string"), e["cnt"]),
    )
    return F.concat(
        F.lit(REPORT_RULE + REPORT_WINDOW_LABEL), java_timestamp_text(window_end), F.lit("\n"),
        F.array_join(lines, ""),
        F.lit(REPORT_RULE + "\n\n"),
    )
