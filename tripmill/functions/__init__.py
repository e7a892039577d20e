"""Column expressions."""

from tripmill.functions.times import as_date, minutes_between
from tripmill.functions.values import is_missing, readable, type_of, unreadable

__all__ = ["as_date", "is_missing", "minutes_between", "readable", "type_of", "unreadable"]
