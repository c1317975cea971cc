"""Column-level building blocks (parsing, predicates, hashing, formatting)."""

from clickwave.functions.formatting import (
    alert_message, epoch_millis, java_timestamp_text, ranking_report,
)
from clickwave.functions.hashing import bitmap_offset, polynomial_hash
from clickwave.functions.parsing import (
    parse_ad_click_line, parse_user_behavior_line, parse_web_log_line,
    seconds_to_event_time, millis_to_event_time, to_event_time,
)
from clickwave.functions.predicates import (
    equals, not_equal_keep_null, not_static_resource, STATIC_RESOURCE_PATTERN,
)

__all__ = [
    "alert_message", "epoch_millis", "java_timestamp_text", "ranking_report",
    "bitmap_offset", "polynomial_hash",
    "parse_ad_click_line", "parse_user_behavior_line", "parse_web_log_line",
    "seconds_to_event_time", "millis_to_event_time", "to_event_time",
    "equals", "not_equal_keep_null", "not_static_resource", "STATIC_RESOURCE_PATTERN",
]
