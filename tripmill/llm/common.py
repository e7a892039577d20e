"""What several operators of this package share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def importable(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver does, wherever the driver was started.

    On a cluster the library is installed or shipped with the job; a path more does no harm there.
    """
    root = str(Path(__file__).resolve().parents[2])
    given = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in given.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [given, root]))


def read_table(spark: SparkSession, tables: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{tables}/{name}.parquet")


def whole_text(column: str | Column) -> Column:
    """The text, NULL read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
