"""Sources: delimited text, web logs, Kafka/socket streams and the driver tables."""

from clickwave.sources.events import (
    ad_clicks_from_events, marketing_from_events, read_table,
    user_behavior_from_events, web_log_from_events, web_log_lines_from_events,
)
from clickwave.sources.text import (
    ad_clicks_from_lines, read_ad_clicks, read_user_behavior, split_rejects,
    user_behavior_from_lines, web_log_from_lines,
)

__all__ = [
    "ad_clicks_from_events", "marketing_from_events", "read_table",
    "user_behavior_from_events", "web_log_from_events", "web_log_lines_from_events",
    "ad_clicks_from_lines", "read_ad_clicks", "read_user_behavior", "split_rejects",
    "user_behavior_from_lines", "web_log_from_lines",
]
