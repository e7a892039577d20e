"""Two trip feeds made from the order lines of the test tables, which have no trip table of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sample_feed(spark: SparkSession, tables: str, service: str) -> DataFrame:
    """The ``green`` or ``yellow`` feed with its raw column names; some values are missing on purpose."""
    status, prefix = {"green": ("O", "lpep"), "yellow": ("F", "tpep")}[service]
    lines = spark.read.parquet(f"{tables}/lineitem.parquet").where(F.col("l_linestatus") == status)
    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    pickup = F.col("l_shipdate")
    ride = line * F.expr("INTERVAL '450' SECOND")
    return lines.select(
        (F.col("l_suppkey") % 2 + 1).cast("int").alias("VendorID"),
        (F.col("l_quantity").cast("int") % 7).alias("passenger_count"),
        (F.col("l_discount") * 100).alias("trip_distance"),
        pickup.alias(f"{prefix}_pickup_datetime"),
        (pickup + ride).alias(f"{prefix}_dropoff_datetime"),
        F.when(part % 50 != 0, (part % 5 + 1).cast("int")).alias("PUlocationID"),
        F.when(part % 40 != 0, (order % 5 + 1).cast("int")).alias("DOlocationID"),
        F.when(line != 7, line).alias("RatecodeID"),
        F.col("l_extendedprice").alias("total_amount"),
        F.when(order % 10 != 0, (order % 5 + 1).cast("int")).alias("payment_type"),
    )
