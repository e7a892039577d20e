"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.scratch import new_folder, stage

# monotonically_increasing_id() counts the rows of a partition in its low 33 bits.
_ROW_BITS = 33


def assign_surrogate_key(
    df: DataFrame, name: str, order_by: Sequence[str] = (), start: int = 1, folder: str | None = None
) -> DataFrame:
    """Put a bigint column ``name`` in front, numbered ``start``, ``start + 1``, ... without gaps.

    With ``order_by`` the numbers follow that order; without it they follow the rows as they lie, which
    saves the shuffle. No window over all rows is used: rows are range-partitioned, each partition counts
    its own rows, and the running total of these counts (one number per partition) is joined back. Rows that
    tie on ``order_by`` are spread by the remaining columns and then by row position, so a frequent value
    does not end up in one partition.

    Each row is staged with its place, below the shared folder or in ``folder``. Counting and numbering then
    see the same places, even if an executor is lost in between.
    """
    columns = df.columns
    if order_by:
        rest = [column for column in columns if column not in order_by]
        order = [*order_by, *rest, "_position"]
        placed = df.withColumn("_position", F.monotonically_increasing_id())
        df = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_position")
    row_in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    rows = stage(
        df.withColumns({"_part": F.spark_partition_id(), "_row": row_in_part}),
        folder or new_folder(df.sparkSession, "numbered"),
    )

    before, offsets = start, []
    for part, count in sorted(rows.groupBy("_part").count().collect()):
        offsets.append((part, before))
        before += count
    # One row per partition of the data: as small as the list of tasks Spark itself keeps. Spark decides how to join.
    offsets = df.sparkSession.createDataFrame(offsets, "_part int, _before bigint")
    return rows.join(offsets, "_part").select((F.col("_before") + F.col("_row")).alias(name), *columns)
