"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.errors import MissingKeysError, MissingOrderError
from tripmill.operators.key_filter import hashes_as_equal


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], ascending: bool = False
) -> DataFrame:
    """Keep, for each combination of ``keys``, the row that comes first in the order of ``order_by``.

    Ties are broken by all other columns in the same direction, so the survivor does not depend on how the
    data happens to be split. Descending puts NULL last and ascending puts it first. NULL keys are equal.

    The first row is taken as the largest (smallest) struct of the non-key columns: an aggregate, which
    Spark combines on the map side. However many rows share a key, each map task sends on one of them, so a
    hot key never gathers in one task. The aggregate sorts; a hash of several keys leads its order, so that nearly
    all comparisons are those of one number, whatever the first key is.
    """
    if not keys:
        raise MissingKeysError("name at least one key column")
    if not order_by:
        raise MissingOrderError("name at least one order column")
    if not isinstance(ascending, bool):
        raise TypeError(f"ascending must be True or False, not {ascending!r}")

    keys = df.select(*keys).columns
    is_key = {name.lower() for name in keys}
    # A key is constant within its group, so it cannot decide the order there.
    ranked = [name for name in df.select(*order_by).columns if name.lower() not in is_key]
    seen = is_key | {name.lower() for name in ranked}
    ranked += [name for name in df.columns if name.lower() not in seen]
    if not ranked:
        return df.dropDuplicates()

    extreme = F.min if ascending else F.max
    hashed = [field.name for field in df.select(*keys).schema if hashes_as_equal(field.dataType)]
    lead = [F.xxhash64(*hashed).alias("_hash")] if len(hashed) > 1 else []
    first = df.groupBy(*lead, *keys).agg(extreme(F.struct(*ranked)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)
