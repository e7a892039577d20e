"""Operators that add derived columns."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import as_date, minutes_between, type_of


def add_calendar_parts(df: DataFrame, source: str, prefix: str = "") -> DataFrame:
    """Add ``<prefix>Year``, ``<prefix>Month`` and ``<prefix>Day`` of ``source``; NULL where it is no date."""
    date = as_date(df[source], type_of(df, source))
    return df.withColumns(
        {f"{prefix}Year": F.year(date), f"{prefix}Month": F.month(date), f"{prefix}Day": F.dayofmonth(date)}
    )


def add_duration_minutes(
    df: DataFrame, output: str, start: str = "PickupTime", end: str = "DropTime"
) -> DataFrame:
    """Add the whole minutes from ``start`` to ``end``; NULL unless both are full dates with a time."""
    minutes = minutes_between(df[start], type_of(df, start), df[end], type_of(df, end))
    return df.withColumn(output, minutes)


# The rate code of a shared ride and the two trip types.
TRIP_TYPE_BY_RATE_CODE = {6: "SharedTrip"}
OTHER_TRIP_TYPE = "SoloTrip"


def classify(
    df: DataFrame,
    output: str,
    source: str = "RatecodeID",
    labels: Mapping[Any, str] = TRIP_TYPE_BY_RATE_CODE,
    otherwise: str = OTHER_TRIP_TYPE,
) -> DataFrame:
    """Replace the code column ``source`` by the label of its code; other codes and NULL get ``otherwise``.

    Codes may be given as text; text that is no number is another code.
    """
    given = df[source]
    if isinstance(type_of(df, source), T.StringType) and not any(isinstance(code, str) for code in labels):
        given = given.try_cast("double")
    label = F.lit(otherwise)
    for code, text in labels.items():
        label = F.when(given == code, F.lit(text)).otherwise(label)
    return df.withColumn(output, label).drop(source)
