"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: static resources excluded from page rankings.  Full match,
# case-sensitive; a query string after the suffix (".js?y") passes.
STATIC_RESOURCE_PATTERN = r"^((?!\.(css|js|png|ico)$).)*$"


def equals(c: Column | str, value) -> Column:
    """``behavior = 'pv'``, ``method = 'GET'``.  Null never matches."""
    return F.col(c) == F.lit(value) if isinstance(c, str) else c == F.lit(value)


def not_equal_keep_null(c: Column | str, value) -> Column:
    """``!"UNINSTALL".equals(behavior)`` keeps rows whose value is null."""
    col = F.col(c) if isinstance(c, str) else c
    return ~col.eqNullSafe(F.lit(value))


def not_static_resource(url: Column | str) -> Column:
    """keep URLs that do not end in .css/.js/.png/.ico."""
    col = F.col(url) if isinstance(url, str) else url
    return col.rlike(STATIC_RESOURCE_PATTERN)
