"""Operators: functions from DataFrame to DataFrame, to be chained with ``DataFrame.transform``."""

from tripmill.operators.cleaning import clean
from tripmill.operators.columns import add_constants, rename_columns, union_feeds
from tripmill.operators.dedup import dedup_by_key
from tripmill.operators.derive import add_calendar_parts, add_duration_minutes, classify
from tripmill.operators.identity import assign_surrogate_key
from tripmill.operators.partitions import touched_partitions
from tripmill.operators.merge import UpsertReport, upsert

__all__ = [
    "UpsertReport",
    "add_calendar_parts",
    "add_constants",
    "add_duration_minutes",
    "assign_surrogate_key",
    "classify",
    "clean",
    "dedup_by_key",
    "rename_columns",
    "touched_partitions",
    "union_feeds",
    "upsert",
]
