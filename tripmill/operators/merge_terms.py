"""The terms of a merge: which rows match, which matched rows change, which columns are set.

All of them speak of the target as ``trg`` and of the source as ``src``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.errors import MergeError, MergeKeysError

Pairs = Sequence[str | tuple[str, str]]


def of(side: str, name: str) -> Column:
    """Column ``name`` of ``trg`` or ``src``."""
    return F.col(f"{side}.`{name}`")


def key_pairs(keys: Pairs) -> list[tuple[str, str]]:
    """Keys as (target column, source column) pairs; one name stands for both."""
    if not keys:
        raise MergeKeysError("name at least one key column")
    return [(key, key) if isinstance(key, str) else (key[0], key[1]) for key in keys]


def assignments(columns: Sequence[str] | Mapping[str, str], identity: str | None = None) -> dict[str, str]:
    """Target column to source column, for updates and inserts alike; the surrogate key is never set."""
    pairs = dict(columns) if isinstance(columns, Mapping) else {name: name for name in columns}
    skipped = identity.lower() if identity else None
    pairs = {target: source for target, source in pairs.items() if target.lower() != skipped}
    if not pairs:
        raise MergeError("no column to set")
    return pairs


def rows_match(pairs: Sequence[tuple[str, str]], null_safe: bool = False) -> Column:
    """All keys are equal. ``null_safe`` lets NULL equal NULL; otherwise a row with a NULL key has no match."""
    sides = [(of("trg", target), of("src", source)) for target, source in pairs]
    return reduce(and_, [t.eqNullSafe(s) if null_safe else t == s for t, s in sides])


def row_changes(set_columns: Mapping[str, str], null_safe: bool = False) -> Column:
    """Some column differs from the value it would be set to.

    A comparison with NULL is unknown and does not count as a change, unless ``null_safe``.
    """
    sides = [(of("trg", target), of("src", source)) for target, source in set_columns.items()]
    return reduce(or_, [~t.eqNullSafe(s) if null_safe else t != s for t, s in sides], F.lit(False))
