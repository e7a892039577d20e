"""Expressions over plain values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def type_of(df: DataFrame, name: str) -> T.DataType:
    """Type of the column ``name``, found without regard to case, as Spark does."""
    for field in df.schema:
        if field.name.lower() == name.lower():
            return field.dataType
    raise ValueError(f"no column {name} among {df.columns}")


def is_missing(column: Column, data_type: T.DataType) -> Column:
    """True for NULL and, in a float column, for NaN.

    The same rows as ``DataFrame.na.drop`` takes out, but written as a plain null test, which Spark hands on
    to the file scan; the expression behind ``na.drop`` stays above the scan.
    """
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def readable(column: Column, data_type: T.DataType) -> Column:
    """Text as a value of ``data_type``; NULL where it cannot be read, never an error.

    A whole number may be written as a decimal one (``1.0``); a number with a fraction is no whole number.
    """
    text = F.trim(column)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        # A failed cast costs an exception, so text that is no number for sure is not tried.
        return F.when(text.rlike("[0-9]|(?i)nan|(?i)inf"), text.try_cast(data_type))
    if not isinstance(data_type, T.IntegralType):
        return text.try_cast(data_type)
    number = text.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast(data_type))
    plain = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast(data_type))
    return F.coalesce(plain, F.when(text.rlike("[0-9]"), whole))


def unreadable(column: Column, data_type: T.DataType) -> Column:
    """Whether text is there and cannot be read as ``data_type``."""
    return column.isNotNull() & (F.trim(column) != "") & readable(column, data_type).isNull()
