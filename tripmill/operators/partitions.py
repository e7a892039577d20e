"""Which partitions a batch touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from tripmill.errors import PartitionColumnError


def touched_partitions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct values of the partition ``columns``, one row each."""
    if not columns:
        raise PartitionColumnError("name at least one partition column")
    try:
        return df.select(*columns).distinct()
    except AnalysisException as error:
        raise PartitionColumnError(str(error)) from error
