"""From raw feeds to one clean trip per business key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import readable, unreadable
from tripmill.operators import (
    add_calendar_parts,
    add_constants,
    add_duration_minutes,
    classify,
    clean,
    dedup_by_key,
    rename_columns,
    union_feeds,
)

# Raw column names, and the names the trips have for them. RatecodeID becomes TripType later.
RAW_COLUMNS = [
    "VendorID", "passenger_count", "trip_distance", "lpep_pickup_datetime", "lpep_dropoff_datetime",
    "PUlocationID", "DOlocationID", "RatecodeID", "total_amount", "payment_type",
]
TRIP_COLUMNS = [
    "VendorID", "PassengerCount", "TripDistance", "PickupTime", "DropTime",
    "PickupLocationId", "DropLocationId", "RatecodeID", "TotalAmount", "PaymentType",
]

# The cleaning rules, for raw and for renamed columns.
RAW_FILTER = "passenger_count > 0 and trip_distance > 0.0"
RAW_REQUIRED = ["PULocationID", "DOLocationID"]
RAW_DEFAULTS = {"payment_type": 5, "RatecodeID": 1}
TRIP_FILTER = "PassengerCount > 0 and TripDistance > 0.0"
TRIP_REQUIRED = ["PickupLocationId"]
TRIP_DEFAULTS = {"PaymentType": 5, "RatecodeID": 1}

# The columns of a trip's business key.
TRIP_KEYS = [
    "PickupTime", "DropTime", "PickupLocationId", "DropLocationId", "PaymentType",
    "VendorID", "PassengerCount", "TripType", "TripMode",
]
# Year and month follow from the time, so they change no match; the table is partitioned by them.
MERGE_KEYS = ["TripYear", "TripMonth", *TRIP_KEYS]


def typed_feed(feed: DataFrame, types: Mapping[str, T.DataType]) -> tuple[DataFrame, Column]:
    """A raw feed with the columns that came as text read as their type, and the number of values of a row that
    cannot be read. Whole numbers that came as floating point become whole numbers, too."""
    wanted = {name.lower(): data_type for name, data_type in types.items()}
    made, bad = {}, F.lit(0)
    for field in feed.schema:
        data_type, column = wanted.get(field.name.lower()), F.col(f"`{field.name}`")
        if data_type is None or field.dataType == data_type:
            continue
        if isinstance(field.dataType, T.StringType):
            made[field.name] = readable(column, data_type)
            bad = bad + F.when(unreadable(column, data_type), 1).otherwise(0)
        elif isinstance(field.dataType, T.FractionalType) and isinstance(data_type, T.IntegralType):
            whole = F.when(column == F.floor(column), column.try_cast(data_type))
            made[field.name] = whole
            bad = bad + F.when(column.isNotNull() & whole.isNull(), 1).otherwise(0)
        elif isinstance(data_type, (T.IntegralType, T.FractionalType)):
            made[field.name] = column.try_cast(data_type)
    return (feed.withColumns(made) if made else feed), bad


def conform_feeds(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Both feeds in one table with one set of names; ``TripMode`` tells them apart."""
    times = ["pickup_datetime", "dropoff_datetime"]
    yellow = rename_columns(yellow, [f"tpep_{name}" for name in times], [f"lpep_{name}" for name in times])
    both = union_feeds(
        add_constants(green, ["TripMode"], ["Green"]),
        add_constants(yellow, ["TripMode"], ["Yellow"]),
    )
    return rename_columns(both, RAW_COLUMNS, TRIP_COLUMNS)


def to_trips(
    conformed: DataFrame,
    required: Sequence[str] = TRIP_REQUIRED,
    order_by: Sequence[str] = ("PickupTime",),
    ascending: bool = False,
) -> DataFrame:
    """Clean, classify, keep one row per business key, and derive calendar parts and duration.

    One shuffle in all. Full duplicates need no step of their own, because they share a business key and
    the row kept for it is determined. Calendar parts and duration follow from the key, so they are derived
    afterwards, for the rows that are left, and are not shuffled.
    """
    trips = clean(conformed, TRIP_FILTER, required, TRIP_DEFAULTS, distinct=False)
    trips = classify(trips, "TripType")
    trips = dedup_by_key(trips, TRIP_KEYS, order_by, ascending)
    trips = add_calendar_parts(trips, "PickupTime", "Trip")
    return add_duration_minutes(trips, "TripTimeInMinutes")
