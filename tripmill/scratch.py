"""Where staged data goes.

A staged table is read back by later jobs, maybe after the executor that wrote it is gone, so it belongs in
the folder all executors share. The cluster names that folder in ``spark.checkpoint.dir``.

Everything here goes through settings, readers, writers and SQL, so it also runs in sessions that have no access
to the driver's JVM.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"
_MASTER = "spark.master"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else one below the warehouse, which is shared as well.

    A warehouse on the driver's own disk is not shared by executors elsewhere: it serves a local session only.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder
    warehouse = spark.conf.get(_WAREHOUSE, None)
    scheme = (warehouse or "").partition(":")[0] if ":" in (warehouse or "") else "file"
    master = spark.conf.get(_MASTER, None) or ""
    alone = master == "local" or master.startswith("local[")
    if not warehouse or (scheme == "file" and not alone):
        raise ValueError(f"{SETTING} must name a folder shared by all executors")
    return f"{warehouse.rstrip('/')}/_staging"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses. It is not created yet."""
    return f"{shared_folder(spark).rstrip('/')}/tripmill/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back.

    The result has a short lineage, column statistics and a known size, so Spark decides from real bytes
    whether a join side is small enough to broadcast.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder made by :func:`new_folder`, on whatever file system it lives.

    A schema is laid over the folder and dropped, which deletes the folder: SQL has no plain delete for files.
    """
    name = f"tripmill_drop_{uuid.uuid4().hex}"
    literal = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{literal}'")
    spark.sql(f"DROP SCHEMA {name} CASCADE")


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A new folder that is gone afterwards, also after an error."""
    path = new_folder(spark, label)
    try:
        yield path
    finally:
        drop_folder(spark, path)
