"""The cleaner: filter, drop incomplete rows, fill defaults, drop full duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions import is_missing, type_of


def clean(
    df: DataFrame,
    where: str | None = None,
    required: Sequence[str] = (),
    defaults: Mapping[str, Any] | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Apply the four cleaning steps, in this order.

    1. keep rows for which the SQL predicate ``where`` is true (NULL is not true);
    2. drop rows that miss any ``required`` column;
    3. fill missing values from ``defaults``;
    4. drop rows equal in all columns, so rows that differed only by NULL versus default collapse.

    ``distinct=False`` leaves out step 4 and its shuffle. It is for callers that go on with a
    :func:`~tripmill.operators.dedup_by_key`, which gives the same rows either way.
    """
    if where:
        df = df.filter(where)
    if required:
        complete = [~is_missing(F.col(name), type_of(df, name)) for name in dict.fromkeys(required)]
        df = df.filter(reduce(and_, complete))
    if defaults:
        df = df.na.fill(dict(defaults))
    return df.dropDuplicates() if distinct else df
