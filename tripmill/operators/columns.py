"""Operators that shape columns: rename, constants, union of feeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_columns(df: DataFrame, old: Sequence[str], new: Sequence[str]) -> DataFrame:
    """Rename ``old[i]`` to ``new[i]``, all at once and in place.

    Names match exactly, columns not listed keep their name, and items of the longer list without a partner
    are ignored. All names change at the same time, so two columns can swap theirs.
    """
    renamed = dict(zip(old, new))
    return df.toDF(*[renamed.get(name, name) for name in df.columns])


def add_constants(df: DataFrame, names: Sequence[str], values: Sequence[Any]) -> DataFrame:
    """Append one constant column per name; a name without a value becomes NULL."""
    taken = {name.lower() for name in df.columns}
    clash = [name for name in names if name.lower() in taken]
    if clash:
        raise ValueError(f"columns exist already: {clash}")
    given = dict(zip(names, values))
    return df.select("*", *[F.lit(given.get(name)).alias(name) for name in names])


def union_feeds(first: DataFrame, *others: DataFrame, by_position: bool = False) -> DataFrame:
    """UNION ALL of feeds; names come from the first one and numeric types widen.

    Columns are matched by name, so a feed with another column order cannot slip values into the wrong
    column. ``by_position=True`` matches them by place, for feeds that name their columns differently.
    """
    union = DataFrame.union if by_position else DataFrame.unionByName
    return reduce(union, others, first)
