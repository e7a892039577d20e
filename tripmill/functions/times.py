"""Date and duration expressions that never raise on malformed text.

Text is guarded by shape and then parsed with the ``try_`` functions, because a value can have the right
shape and still be no date (``2025-13-45``), which raises under ANSI mode. Columns that already are dates or
timestamps skip the guard: formatting every value only to match it against a pattern would be wasted work.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text shape accepted as a date, and the format of a date with a time.
DATE_SHAPE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# All text the format can parse has this shape. Where a parse fails, Spark throws and catches an exception
# inside the try_ function; on dirty data that would cost far more than this match.
_DATETIME_SHAPE = r"^[+-]?[0-9]{4,}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"

_INSTANTS = (T.TimestampType, T.TimestampNTZType)


def as_date(column: Column, data_type: T.DataType) -> Column:
    """``column`` as a date; NULL where its text does not hold a date."""
    if isinstance(data_type, (*_INSTANTS, T.DateType)):
        return column.cast("date")
    text = column.cast("string")
    return F.when(text.rlike(DATE_SHAPE), text.try_cast("date"))


def _epoch_seconds(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, _INSTANTS):
        return F.unix_timestamp(column)
    text = column.cast("string")
    parsed = F.try_to_timestamp(text, F.lit(DATETIME_FORMAT))
    return F.when(text.rlike(_DATETIME_SHAPE), F.unix_timestamp(parsed))


def minutes_between(start: Column, start_type: T.DataType, end: Column, end_type: T.DataType) -> Column:
    """Minutes from ``start`` to ``end``, rounded half up; negative if ``end`` is earlier.

    NULL if either side is not a full date with a time, so a plain date has no duration.
    """
    return F.round((_epoch_seconds(end, end_type) - _epoch_seconds(start, start_type)) / 60)
