"""The monthly run: read a month of both feeds, make trips, load them into the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators import UpsertReport, upsert
from tripmill.plans.trips import MERGE_KEYS, RAW_COLUMNS, conform_feeds, to_trips, typed_feed
from tripmill.scratch import drop_folder
from tripmill.sources import Table, ensure_table, files_at, read_feeds, read_or_quarantine


@dataclass(frozen=True)
class Feed:
    """Where a feed's files of a month lie, and the columns to take from them."""

    path: str
    columns: Sequence[str]


# File layout of the two feeds below the landing folder. The yellow feed names its times tpep_*.
FEEDS = {
    "green": Feed("green/green_tripdata_{month}.csv.gz", RAW_COLUMNS),
    "yellow": Feed(
        "yellow/yellow_tripdata_{month}.csv.gz",
        [name.replace("lpep_", "tpep_") for name in RAW_COLUMNS],
    ),
}

# Types of the raw columns and of the trip table.
RAW_TYPES = {
    "VendorID": T.IntegerType(),
    "passenger_count": T.IntegerType(),
    "trip_distance": T.DoubleType(),
    "lpep_pickup_datetime": T.TimestampType(),
    "lpep_dropoff_datetime": T.TimestampType(),
    "tpep_pickup_datetime": T.TimestampType(),
    "tpep_dropoff_datetime": T.TimestampType(),
    "PUlocationID": T.IntegerType(),
    "DOlocationID": T.IntegerType(),
    "RatecodeID": T.IntegerType(),
    "total_amount": T.DoubleType(),
    "payment_type": T.IntegerType(),
}
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("PassengerCount", T.IntegerType()),
        T.StructField("TripDistance", T.DoubleType()),
        T.StructField("PickupTime", T.TimestampType()),
        T.StructField("DropTime", T.TimestampType()),
        T.StructField("PickupLocationId", T.IntegerType()),
        T.StructField("DropLocationId", T.IntegerType()),
        T.StructField("TotalAmount", T.DoubleType()),
        T.StructField("PaymentType", T.IntegerType()),
        T.StructField("TripYear", T.IntegerType()),
        T.StructField("TripMonth", T.IntegerType()),
        T.StructField("TripDay", T.IntegerType()),
        T.StructField("TripTimeInMinutes", T.DoubleType()),
        T.StructField("TripType", T.StringType()),
        T.StructField("TripMode", T.StringType()),
    ]
)


def trip_table(name: str, path: str) -> Table:
    """The trip table: partitioned by year and month, clustered by time, numbered by ``TaxiDataId``."""
    return Table(
        path=path,
        partition_by=("TripYear", "TripMonth"),
        identity="TaxiDataId",
        name=name,
        cluster_by=("PickupTime",),
    )


def _plain(month: str) -> str:
    """A month, or a glob over months, as the name of a folder."""
    return "".join(char if char.isalnum() or char in "-_" else f"%{ord(char):02X}" for char in month)


def _counted(feed: DataFrame, types: Mapping[str, T.DataType]) -> tuple[DataFrame, Observation]:
    """The typed feed; whoever reads it all counts its unreadable values on the way."""
    _, bad = typed_feed(feed, types)
    seen = Observation()
    # Counted on the text, before it is read as another type.
    return typed_feed(feed.observe(seen, F.coalesce(F.sum(bad), F.lit(0)).alias("unreadable")), types)[0], seen


# The files a landed feed was made of: their paths, sizes and times.
_MADE_OF = "path string, modificationTime timestamp, length long"


def land_feed(spark: SparkSession, path: str, columns: Sequence[str], landed: str, separator: str = ",") -> DataFrame:
    """The text columns of a feed, from Parquet at ``landed``, which is written if it isn't there yet.

    A gzip file is read by one task each time; landed once, it is read by as many as there are. What is there is taken
    if it was made of the very files that lie at ``path`` now (by path, size and time), else it is written anew. The
    list of files is written last, so a landing that died is not taken for a whole one.
    """
    now = files_at(spark, path).select("path", "modificationTime", "length")
    listed, rows = f"{landed.rstrip('/')}/files", f"{landed.rstrip('/')}/rows"
    try:
        before = spark.read.schema(_MADE_OF).parquet(listed)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        before = None
    if before is None or sorted(map(tuple, before.collect())) != sorted(map(tuple, now.collect())):
        drop_folder(spark, landed)
        as_text = dict.fromkeys(columns, T.StringType())
        feed = read_feeds(spark, [(path, columns)], types=as_text, separator=separator)[0]
        # Rows are spread over all tasks here, once, instead of by each run.
        feed.repartition(spark.sparkContext.defaultParallelism).write.parquet(rows)
        now.coalesce(1).write.parquet(listed)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return spark.read.schema(schema).parquet(rows)


def run_month(
    spark: SparkSession,
    landing: str,
    month: str,
    table: Table,
    types: Mapping[str, T.DataType] | None = RAW_TYPES,
    null_safe_keys: bool = False,
    separator: str = ",",
    landed: str | None = None,
    quarantine: str | None = None,
) -> UpsertReport:
    """Load the trips of ``month`` (``yyyy-MM``, or a glob over months) into ``table``; create it if needed.

    ``types=None`` lets Spark infer the raw types, at the price of reading every file twice; the trips are the
    same. Values that cannot be read as their type are NULL, and the report counts them. The trips are computed
    once: the upsert stages them, which takes the place of a cache and survives lost executors.

    ``landed`` names a folder for the feeds as Parquet: a month that is run again reads no gzip (see
    :func:`land_feed`). ``quarantine`` names a folder for lines that can't be read: they are not loaded, and
    ``<quarantine>/<feed>/<month>`` has them with their file and the reason. The two exclude each other, because
    a landed feed has no lines.
    """
    if landed and quarantine:
        raise ValueError("lines are set aside as they are delivered, not from landed feeds")
    if quarantine and types is None:
        raise ValueError("what can't be read is known for given types only")
    locations = [
        (f"{landing.rstrip('/')}/{feed.path.format(month=month)}", feed.columns) for feed in FEEDS.values()
    ]
    as_text = None if types is None else dict.fromkeys(types, T.StringType())
    set_aside = 0
    if landed:
        places = [f"{landed.rstrip('/')}/{name}/{_plain(month)}" for name in FEEDS]
        feeds = [land_feed(spark, path, columns, place, separator) for (path, columns), place in zip(locations, places)]
    elif quarantine:
        feeds = []
        for name, (path, columns) in zip(FEEDS, locations):
            good, bad = read_or_quarantine(spark, path, columns, types, separator=separator)
            place = f"{quarantine.rstrip('/')}/{name}/{_plain(month)}"
            bad.write.mode("overwrite").parquet(place)
            set_aside += spark.read.schema(bad.schema).parquet(place).count()
            feeds.append(good)
    else:
        feeds = read_feeds(spark, locations, types=as_text, separator=separator)
    (green, of_green), (yellow, of_yellow) = (_counted(feed, types or RAW_TYPES) for feed in feeds)
    trips = to_trips(conform_feeds(green, yellow))
    ensure_table(spark, TRIP_SCHEMA, table)
    report = upsert(trips, table, MERGE_KEYS, null_safe_keys=null_safe_keys)
    unread = of_green.get["unreadable"] + of_yellow.get["unreadable"]
    return replace(report, unreadable=unread, quarantined=set_aside)
