"""DataFrame -> DataFrame operators."""

from clickwave.operators.aggregates import (
    bitmap_distinct_count, distinct_count, running_distinct_count, salted_count, tumbling_sum,
)
from clickwave.operators.fraud import blacklist_alerts, cap_clicks, passed_clicks, reset_day
from clickwave.operators.lateness import split_late
from clickwave.operators.ranking import (
    ranking_reports, top_n, top_n_by_count,
)
from clickwave.operators.scan import running_aggregate
from clickwave.operators.windows import (
    expand_runs, sliding_count_runs, sliding_counts, sliding_distinct_count, sliding_distinct_sketch, tumbling_counts, window_end,
)

__all__ = [
    "bitmap_distinct_count", "distinct_count", "running_distinct_count", "salted_count", "tumbling_sum",
    "blacklist_alerts", "cap_clicks", "passed_clicks", "reset_day", "split_late",
    "ranking_reports", "top_n", "top_n_by_count", "running_aggregate",
    "expand_runs", "sliding_count_runs", "sliding_counts",
    "sliding_distinct_count", "sliding_distinct_sketch", "tumbling_counts", "window_end",
]
