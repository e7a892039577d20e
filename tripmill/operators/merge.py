"""Upsert into a table."""

from __future__ import annotations

import datetime as dt
import random
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property, reduce
from itertools import count as count_up
from operator import and_, or_
from urllib.parse import unquote

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.errors import DuplicateSourceKeyError, MergeError, MergeKeysError, PartitionColumnError
from tripmill.operators.key_filter import KeyFilter, hashes_as_equal
from tripmill.operators.merge_terms import Pairs, assignments, key_pairs, of, row_changes, rows_match
from tripmill.operators.partitions import touched_partitions
from tripmill.scratch import drop_folder, scratch_folder, stage
from tripmill.sources.tables import (
    Table,
    dealt_by_partition,
    hashed_columns,
    point_partitions,
    row_hash,
    stored_rows,
    timestamps_with_statistics,
    with_fingerprint,
    write_table,
)

# Key types whose smallest and largest source value narrow the scan of the target.
_RANGED = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Ranges that are pushed to the scan for a key, whatever the number of touched partitions.
_MAX_RANGES = 64
# Of more ranges than these, neighbours with a small gap between them become one.
_FEW_RANGES = 8
# From so many source rows on, the target's rows are tested against a filter of the source's keys before the join.
_FILTER_FROM_ROWS = 500_000
# monotonically_increasing_id() counts the rows of a partition in its low 33 bits.
_ROW_BITS = 33


@dataclass(frozen=True)
class UpsertReport:
    """What an upsert did. ``matched`` and ``updated`` count target rows, the other counts source rows."""

    source_rows: int = 0
    matched: int = 0
    updated: int = 0
    inserted: int = 0
    rewritten_partitions: tuple[tuple[str | None, ...], ...] = ()
    # Values of the raw feeds that could not be read as their type; set by the monthly run.
    unreadable: int = 0
    # Lines of the raw feeds that were set aside; set by the monthly run.
    quarantined: int = 0


@dataclass(frozen=True)
class _Merge:
    """One upsert, with all names resolved against its two sides."""

    target: DataFrame
    table: Table
    pairs: list[tuple[str, str]]
    set_columns: dict[str, str]
    changes: Column
    null_safe_keys: bool
    # Keys whose range in the source narrows the scan.
    ranged: list[str]
    source_types: dict[str, T.DataType]
    # Whether the source gives all that the target's fingerprints are made of.
    by_fingerprint: bool

    @property
    def match(self) -> Column:
        return rows_match(self.pairs, self.null_safe_keys)

    @property
    def join_match(self) -> Column:
        """The match, led by one hash of all keys where there are several.

        A join sorts by its first key first, and a year or a month settles hardly a comparison.
        """
        hashed = [(t, s) for t, s in self.alike if hashes_as_equal(self.types[t])]
        if len(hashed) < 2:
            return self.match
        sides = [F.xxhash64(*(of(side, pair[i]) for pair in hashed)) for i, side in enumerate(("trg", "src"))]
        return (sides[0] == sides[1]) & self.match

    @property
    def source_keys(self) -> list[str]:
        return [source for _, source in self.pairs]

    @cached_property
    def types(self) -> dict[str, T.DataType]:
        return {field.name: field.dataType for field in self.target.schema}

    @property
    def partition_values(self) -> list[Column]:
        """The target's partition values of a source row."""
        source_of = dict(self.pairs)
        values = [F.col(f"`{source_of[name]}`").cast(self.types[name]).alias(name) for name in self.table.partition_by]
        slices = self.table.slices
        if slices:
            values.append(slices.value(lambda name: F.col(f"`{source_of[name]}`"), self.types))
        return values

    @property
    def may_change(self) -> Column:
        """False only for matches whose target row has the fingerprint that the source row would give it."""
        hashed = hashed_columns(self.table, self.target.columns)
        given = row_hash([of("src", self.set_columns[name]).cast(self.types[name]) for name in hashed])
        return ~of("trg", self.table.fingerprint).eqNullSafe(given)

    @property
    def alike(self) -> list[tuple[str, str]]:
        """Keys of one type on both sides, whose values therefore have one hash."""
        return [(t, s) for t, s in self.pairs if self.types[t] == self.source_types[s]]


def upsert(
    source: DataFrame,
    table: Table,
    keys: Pairs,
    columns: Sequence[str] | Mapping[str, str] | None = None,
    update_when: str | None = None,
    null_safe_keys: bool = False,
    null_safe_compare: bool = False,
) -> UpsertReport:
    """Update the rows of ``table`` that ``source`` matches by ``keys`` and insert the other source rows.

    ``keys`` are column names, or (target, source) pairs. ``columns`` are the columns to set, as names or as
    target-to-source mapping; by default all of the source but the surrogate key. A matched row is updated
    if ``update_when`` holds, SQL text over ``trg`` and ``src``; by default if any set column differs. No
    row is ever deleted.

    NULL follows SQL: a NULL key matches nothing, so such rows are inserted again by each run, and a
    comparison with NULL is no difference. ``null_safe_keys`` and ``null_safe_compare`` make NULL equal to
    NULL and different from any value; with the first, running the same batch twice changes nothing.

    Several source rows for one target row raise :class:`DuplicateSourceKeyError` before anything is written.

    How it scales:

    * Only partitions the source has values for are read, by a semi join that prunes them, and in them only
      the key ranges the source covers. The scan gets at most ``_MAX_RANGES`` ranges a key, the join tests those of each
      partition; so the plan does not grow with the number of partitions. Partition columns must be keys.
    * A large source is looked up behind a filter of its keys (see :class:`~tripmill.operators.key_filter.KeyFilter`):
      target rows that no source row can match are dropped by the scan's task and never shuffled.
    * One join looks up matches and keeps nothing but row numbers, keys and changed rows. New rows are appended.
      Only partitions that hold a *changed* row are rewritten, so a batch of new rows rewrites nothing. With
      ``Table.slices`` a partition is many slices, and only slices with a changed row are rewritten.
    * With ``Table.fingerprint`` the look-up reads keys and one number of each target row; other columns are read only
      where a row may change.
    * No join here is a full outer join: for inner, left and anti joins adaptive execution can split a
      key with very many rows, for full outer joins it cannot. Source rows with a NULL key, which may be
      very many, are never compared.
    * The source and the looked-up changes are staged as parquet in the shared folder. A lost executor
      cannot make a later step see other rows than an earlier one, and a join side is broadcast only if
      its size, known by then, is below Spark's threshold. What is staged there is gone afterwards.
    * New numbers come from the highest number given so far, which is kept in a folder beside the table, so
      no partition is scanned for it. Numbers of source rows that were not inserted are skipped.

    Plain parquet has no transactions, so a table must have one writer at a time. What replaces changed
    partitions is written in full beside the table first, and then noted as complete. A partitioned table with a name
    is then switched: the catalog points each changed partition to its new folder, so rows are written once, and the
    old folder is deleted at the end. A table without a name, or without partitions, is overwritten from what was
    written beside it. If the job dies in between, the next upsert starts by finishing what was noted, so no row is
    lost. New rows are appended last; run the batch again if they are not there.

    A table whose ``format`` is not parquet is merged by its own MERGE, and nothing else is tried.
    """
    spark = source.sparkSession
    if table.format != "parquet":
        return _merge_natively(source, table, keys, columns, update_when, null_safe_keys, null_safe_compare)
    recover(spark, table)
    merge = _resolve(source, table, keys, columns, update_when, null_safe_keys, null_safe_compare)
    with scratch_folder(spark, "upsert") as folder:
        return _upsert(merge, source, folder)


def _upsert(merge: _Merge, source: DataFrame, folder: str) -> UpsertReport:
    table = merge.table
    numbered = _without_void(source).withColumn("_sid", F.monotonically_increasing_id())
    staged = stage(numbered, f"{folder}/source")
    touched = stage(_touched(merge, staged), f"{folder}/touched")
    source_rows, ranges = _ranges(merge, touched)
    if source_rows == 0:
        return UpsertReport()

    matchable = staged
    if not merge.null_safe_keys:
        matchable = staged.filter(reduce(and_, [F.col(f"`{key}`").isNotNull() for key in merge.source_keys]))
    nearby = _nearby(merge, touched, ranges)
    if source_rows >= _FILTER_FROM_ROWS and merge.alike:
        ours, theirs = zip(*merge.alike)
        nearby = nearby.filter(KeyFilter.of(matchable, theirs, source_rows).may_hold(ours))
    if merge.by_fingerprint:
        found = stage(_look_up(merge, nearby, matchable, merge.may_change), f"{folder}/candidates")
        hits = stage(_confirmed(merge, found), f"{folder}/hits")
    else:
        hits = stage(_look_up(merge, nearby, matchable, merge.changes), f"{folder}/hits")
    per_key = hits.groupBy(*merge.source_keys).agg(
        F.count("*").alias("matched"),
        F.count_if("_changed").alias("updated"),
        (F.min("_sid") != F.max("_sid")).alias("repeated"),
    )
    found, matched, updated, repeated = per_key.agg(
        F.count("*"), F.sum("matched"), F.sum("updated"), F.max("repeated")
    ).first()
    if repeated:
        raise DuplicateSourceKeyError(f"several source rows match one target row by {merge.source_keys}")

    rewritten = ()
    if updated:
        # One source row may change several target rows.
        changed = hits.filter("_changed").drop("_changed").dropDuplicates(["_sid"]).drop("_sid")
        rewritten = _switch(merge, changed)
    inserted = source_rows - found
    if inserted:
        new = staged.join(hits.select("_sid"), "_sid", "left_anti") if found else staged
        write_table(_as_target(merge, new, staged, source_rows), table, "append")
    return UpsertReport(source_rows, matched or 0, updated or 0, inserted, rewritten)


# ---- replacing partitions

# What is noted as complete beside the table: one row for each partition, or one for a table overwritten as a whole.
# ``folder`` holds the new rows, ``replaced`` are folders of the old ones, to be deleted in the end.
_NOTE = "partition array<string>, folder string, replaced array<string>"
# The folder of a file. File paths are given with what is special in them as percent codes.
_FOLDER_OF_FILE = "regexp_replace(_metadata.file_path, '/[^/]*$', '')"


def _pending(table: Table) -> str:
    """The folder beside the table that tells what is about to replace some of its rows."""
    return f"{table.path.rstrip('/')}_pending"


def _as_names(table: Table) -> list[Column]:
    """Partition values as text like in the folder names."""
    return [F.col(f"`{name}`").cast("string").alias(name) for name in table.stored_by]


def _by_folder(rows: DataFrame, table: Table) -> dict[tuple, list[str]]:
    """The folders of partitions, by their values as text."""
    folders = {}
    for *values, folder in rows.select(*_as_names(table), "_folder").distinct().collect():
        folders.setdefault(tuple(values), []).append(unquote(folder))
    return folders


def _switch(merge: _Merge, changed: DataFrame) -> tuple[tuple[str | None, ...], ...]:
    """Write the changed partitions, or the table if it has none, in full beside the table, and change over."""
    spark, table = changed.sparkSession, merge.table
    target, old = merge.target, {}
    if table.stored_by:
        parts = touched_partitions(changed.select(*merge.partition_values), table.stored_by).withColumn("_rows", F.lit(1))
        target = _in_partitions(merge, parts, merge.target)
        if table.switchable:
            files = merge.target.withColumn("_folder", F.expr(_FOLDER_OF_FILE)).select(*table.stored_by, "_folder")
            old = _by_folder(_in_partitions(merge, parts, files), table)
    new = f"{table.path.rstrip('/')}_versions/{uuid.uuid4().hex}" if table.switchable else f"{_pending(table)}/rows"
    try:
        replaced = _replace(merge, target, changed)
        if table.switchable:
            with timestamps_with_statistics(spark):
                dealt_by_partition(replaced, table).write.partitionBy(*table.stored_by).parquet(new)
            written = spark.read.schema(merge.target.schema).parquet(new)
            places = _by_folder(written.withColumn("_folder", F.expr(_FOLDER_OF_FILE)), table)
            note = [(list(values), folder, old.get(values, [])) for values, (folder,) in places.items()]
        else:
            replaced.write.parquet(new)
            note = [(None, new, [])]
        spark.createDataFrame(note, _NOTE).coalesce(1).write.parquet(f"{_pending(table)}/complete")
    except Exception:
        drop_folder(spark, _pending(table))
        if table.switchable:
            drop_folder(spark, new)
        raise
    return _change_over(spark, table, note, merge.target.schema)


def _change_over(
    spark: SparkSession, table: Table, note: Sequence[tuple], schema: T.StructType
) -> tuple[tuple[str | None, ...], ...]:
    """Let the table have the rows that the note tells of, and forget the note."""
    (partition, folder, _) = note[0]
    try:
        if partition is not None:
            values = [tuple(row[0]) for row in note]
            point_partitions(spark, table, [(tuple(row[0]), row[1]) for row in note])
        else:
            written = spark.read.schema(schema).parquet(folder)
            values = [()]
            if table.stored_by:
                values = [tuple(row) for row in written.select(*_as_names(table)).distinct().collect()]
            write_table(written, table, "partitions" if table.stored_by else "overwrite")
    except Exception as error:
        raise MergeError(f"the table was not changed over in full; {_pending(table)} tells how, the next upsert goes on") from error
    drop_folder(spark, _pending(table))
    for _, folder, replaced in note:
        for old in replaced:
            # A change-over that is done again finds the new folder in place of the old one.
            if old != unquote(folder):
                drop_folder(spark, old)
    if not table.stored_by:
        return ()
    return tuple(sorted(values, key=lambda v: [(x is None, x or "") for x in v]))


def recover(spark: SparkSession, table: Table) -> bool:
    """Finish a replacement that was complete beside the table when its job died; tell whether there was one.

    A note that was not written in full is cleared: nothing was changed over by then.
    """
    note = _if_there(spark.read.schema(_NOTE), f"{_pending(table)}/complete")
    if note is None:
        return False
    rows = [tuple(row) for row in note.collect()]
    if not rows:
        drop_folder(spark, _pending(table))
        return False
    _change_over(spark, table, rows, stored_rows(spark, table).schema)
    return True


def _if_there(reader: DataFrameReader, path: str) -> DataFrame | None:
    """The parquet files at ``path``, or None if there is no such path. Any other error is one."""
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _resolve(
    source: DataFrame,
    table: Table,
    keys: Pairs,
    columns: Sequence[str] | Mapping[str, str] | None,
    update_when: str | None,
    null_safe_keys: bool,
    null_safe_compare: bool,
) -> _Merge:
    """Check every argument before any job runs."""
    pairs = key_pairs(keys)
    set_columns = assignments(source.columns if columns is None else columns, table.identity)
    try:
        target = stored_rows(source.sparkSession, table)
    except AnalysisException as error:
        raise MergeError(f"no readable target: {error}") from error

    spelled = [{name.lower(): name for name in side.columns} for side in (target, source)]
    try:
        pairs = [(spelled[0][t.lower()], spelled[1][s.lower()]) for t, s in pairs]
    except KeyError as error:
        raise MergeKeysError(f"no column {error} to match by") from error
    try:
        set_columns = {spelled[0][t.lower()]: spelled[1][s.lower()] for t, s in set_columns.items()}
    except KeyError as error:
        raise MergeError(f"no column {error} to set") from error
    for name in (*table.partition_by, *(table.slices.by if table.slices else ())):
        if name not in dict(pairs) or set_columns.get(name) != dict(pairs)[name]:
            raise PartitionColumnError(f"partition column {name} must be a key and be set from that key")
    for name in table.hidden:
        if name in set_columns:
            raise PartitionColumnError(f"{name} follows from other columns and is not set")

    if update_when is None:
        # Equal by the match, so a key cannot be what changed.
        compared = {t: s for t, s in set_columns.items() if (t, s) not in pairs}
        changes = row_changes(compared, null_safe_compare)
    else:
        changes = _checked_condition(update_when, target, source)
    types = [{field.name: field.dataType for field in side.schema} for side in (target, source)]
    ranged = [
        t
        for t, s in pairs
        if t not in table.partition_by and _has_ranges(types[0][t]) and types[0][t] == types[1][s]
    ]
    changes = F.coalesce(changes, F.lit(False))
    hashed = hashed_columns(table, target.columns)
    by_fingerprint = bool(
        update_when is None and table.fingerprint in target.columns and all(name in set_columns for name in hashed)
    )
    return _Merge(target, table, pairs, set_columns, changes, null_safe_keys, ranged, types[1], by_fingerprint)


def _has_ranges(data_type: T.DataType) -> bool:
    """Whether values are ordered like numbers of 28 digits before and 10 after the point."""
    if isinstance(data_type, T.DecimalType):
        return data_type.scale <= 10 and data_type.precision - data_type.scale <= 28
    return isinstance(data_type, _RANGED)


def _merge_natively(
    source: DataFrame,
    table: Table,
    keys: Pairs,
    columns: Sequence[str] | Mapping[str, str] | None,
    update_when: str | None,
    null_safe_keys: bool,
    null_safe_compare: bool,
) -> UpsertReport:
    """The same merge by the table format's own MERGE. What it did is in the format's own history."""
    if table.name is None:
        raise MergeError(f"a {table.format} table is merged by its catalog name, and it has none")
    merge = _resolve(source, table, keys, columns, update_when, null_safe_keys, null_safe_compare)
    values = {name: of("src", given) for name, given in merge.set_columns.items()}
    try:
        changes = source.alias("src").mergeInto(f"{table.name} AS trg", merge.match)
        changes = changes.whenMatched(merge.changes).update(values).whenNotMatched().insert(values)
        changes.merge()
    except PySparkException as error:
        raise MergeError(f"{table.name} ({table.format}) cannot be merged: {error}") from error
    return UpsertReport(source_rows=source.count())


def _checked_condition(update_when: str, target: DataFrame, source: DataFrame) -> Column:
    """``update_when`` as a column, if it is a condition over the two sides."""
    try:
        condition = F.expr(update_when)
        sides = target.alias("trg").join(source.alias("src"), F.lit(False))
        data_type = sides.select(condition).schema[0].dataType
    except (AnalysisException, ParseException) as error:
        raise MergeError(f"bad change condition: {error}") from error
    if not isinstance(data_type, T.BooleanType):
        raise MergeError(f"the change condition gives {data_type.simpleString()}, not true or false")
    return condition


def _without_void(df: DataFrame) -> DataFrame:
    """Parquet cannot store a column that has no type because it is NULL throughout."""
    void = [field.name for field in df.schema if isinstance(field.dataType, T.NullType)]
    return df.withColumns({name: F.col(f"`{name}`").cast("string") for name in void})


def _touched(merge: _Merge, staged: DataFrame) -> DataFrame:
    """The touched partitions, with the source's rows and the range of each key in them.

    A stray row from another year then widens the scan by its own partition and range only, not by all that
    lies between.
    """
    ends = []
    for i, name in enumerate(merge.ranged):
        key = f"`{dict(merge.pairs)[name]}`"
        ends += [F.min(key).alias(f"_min_{i}"), F.max(key).alias(f"_max_{i}")]
    return staged.groupBy(*merge.partition_values).agg(F.count("*").alias("_rows"), *ends)


def _ranges(merge: _Merge, touched: DataFrame) -> tuple[int, dict[str, list[tuple[Column, Column]]]]:
    """The number of source rows, and for each ranged key a few ranges that cover those of all touched partitions.

    Up to ``_MAX_RANGES`` partitions keep their ranges. Those of more are brought together by the bucket, of as many
    equal spans, that they start in. Ranges that overlap become one. What gets here is one small row a key and bucket.
    """
    keys = [(i, name, merge.types[name]) for i, name in enumerate(merge.ranged)]
    ends = [F.struct(F.min(_ordinal(f"_min_{i}", kind)), F.max(_ordinal(f"_max_{i}", kind))) for i, _, kind in keys]
    source_rows, partitions, *spans = touched.agg(F.sum("_rows"), F.count("*"), *ends).first()
    if not source_rows or not keys:
        return source_rows or 0, {}
    rows = []
    for (i, _, kind), (low, high) in zip(keys, spans):
        start = _ordinal(f"_min_{i}", kind)
        if partitions <= _MAX_RANGES or low is None or low == high:
            bucket = F.monotonically_increasing_id() if partitions <= _MAX_RANGES else F.lit(0).cast("long")
        else:
            width = float(high - low) / _MAX_RANGES
            bucket = F.least(F.floor((start - F.lit(low)).cast("double") / width), F.lit(_MAX_RANGES - 1))
        rows.append(F.struct(F.lit(i).alias("key"), bucket.alias("bucket"), start.alias("low"), _ordinal(f"_max_{i}", kind).alias("high")))
    found = touched.select(F.inline(F.array(*rows))).filter("low IS NOT NULL")
    found = found.groupBy("key", "bucket").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    ranges = {name: [] for _, name, _ in keys}
    for i, low, high in sorted(tuple(row) for row in found.select("key", "low", "high").collect()):
        covered = ranges[merge.ranged[i]]
        if covered and low <= covered[-1][1]:
            covered[-1] = (covered[-1][0], max(high, covered[-1][1]))
        else:
            covered.append((low, high))
    return source_rows, {
        name: [(_from_ordinal(low, kind), _from_ordinal(high, kind)) for low, high in _fewer(ranges[name])]
        for _, name, kind in keys
    }


def _fewer(covered: Sequence[tuple[Decimal, Decimal]]) -> list[tuple[Decimal, Decimal]]:
    """Ranges in order, the closest of them brought together while there are more than ``_FEW_RANGES``.

    Only gaps of at most a quarter of the ranges on both sides are closed, as between months: little more is read for
    them, and each range is a test of every row, in code that is too long to be compiled if there are very many.
    """
    widths = [high - low for low, high in covered]
    small = [(covered[i + 1][0] - covered[i][1], i) for i in range(len(covered) - 1)]
    small = sorted((gap, i) for gap, i in small if 4 * gap <= min(widths[i], widths[i + 1]))
    closed = {i for _, i in small[: max(0, len(covered) - _FEW_RANGES)]}
    fewer: list[tuple[Decimal, Decimal]] = []
    for i, (low, high) in enumerate(covered):
        if i - 1 in closed:
            fewer[-1] = (fewer[-1][0], high)
        else:
            fewer.append((low, high))
    return fewer


_EPOCH = dt.datetime(1970, 1, 1)


def _ordinal(name: str, data_type: T.DataType) -> Column:
    """A value as an exact number in the same order: days of a date, microseconds of a time."""
    column = F.col(name)
    if isinstance(data_type, T.DateType):
        column = F.unix_date(column)
    elif isinstance(data_type, T.TimestampType):
        column = F.unix_micros(column)
    elif isinstance(data_type, T.TimestampNTZType):
        column = F.timestamp_diff("MICROSECOND", F.lit(str(_EPOCH)).cast("timestamp_ntz"), column)
    return column.cast("decimal(38,10)")


def _from_ordinal(number: Decimal, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.DateType):
        return F.date_from_unix_date(F.lit(int(number)))
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(F.lit(int(number)))
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(str(_EPOCH + dt.timedelta(microseconds=int(number)))).cast("timestamp_ntz")
    return F.lit(str(number) if isinstance(data_type, T.DecimalType) else str(int(number))).cast(data_type)


def _nearby(merge: _Merge, touched: DataFrame, ranges: Mapping[str, Sequence[tuple[Column, Column]]]) -> DataFrame:
    """The target rows that the source can match at all."""
    nearby = merge.target
    for name, covered in ranges.items():
        column = F.col(f"`{name}`")
        inside = [column.between(low, high) for low, high in covered]
        nearby = nearby.filter(_any([*inside, column.isNull()] if merge.null_safe_keys else inside))
    return _in_partitions(merge, touched, nearby, within=True) if merge.table.stored_by else nearby


def _in_partitions(merge: _Merge, touched: DataFrame, rows: DataFrame, within: bool = False) -> DataFrame:
    """The target's ``rows`` in the ``touched`` partitions; ``within`` the key ranges noted for each of them, too.

    The semi join prunes partitions by itself, because its other side is filtered. NULL is no value to prune by:
    rows with a NULL partition value are taken in a branch of their own, if NULL keys can match.
    """
    columns = list(merge.table.stored_by)
    values = touched.filter("_rows > 0")
    ranges = [F.lit(True)]
    for i, name in enumerate(merge.ranged if within else []):
        inside = of("trg", name).between(F.col(f"prt._min_{i}"), F.col(f"prt._max_{i}"))
        ranges.append(inside | of("trg", name).isNull() if merge.null_safe_keys else inside)

    def semi(rows: DataFrame, values: DataFrame, same: list[Column]) -> DataFrame:
        joined = rows.alias("trg").join(values.alias("prt"), reduce(and_, [*same, *ranges]), "left_semi")
        return joined.select(*[of("trg", name).alias(name) for name in rows.columns])

    inside = semi(rows, values, [of("trg", name) == of("prt", name) for name in columns])
    if not merge.null_safe_keys:
        return inside
    missing = reduce(or_, [F.col(f"`{name}`").isNull() for name in columns])
    if values.filter(missing).isEmpty():
        return inside
    same = [of("trg", name).eqNullSafe(of("prt", name)) for name in columns]
    return inside.unionAll(semi(rows.filter(missing), values.filter(missing), same))


def _any(conditions: Sequence[Column]) -> Column:
    """OR of many conditions as a balanced tree: a chain of thousands would overflow the optimizer's stack."""
    if not conditions:
        return F.lit(False)
    while len(conditions) > 1:
        conditions = [reduce(or_, conditions[i : i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]


def _confirmed(merge: _Merge, found: DataFrame) -> DataFrame:
    """The matches of ``found``, with those that may change looked up again by the compared columns.

    A fingerprint only tells what has not changed: NULL may count as no change, and rows may have no fingerprint. The
    compared columns are read in the partitions of such rows only.
    """
    candidates = found.filter("_changed").drop("_changed").dropDuplicates(["_sid"])
    target = merge.target
    if merge.table.stored_by:
        parts = touched_partitions(candidates.select(*merge.partition_values), merge.table.stored_by)
        target = _in_partitions(merge, parts.withColumn("_rows", F.lit(1)), target)
    again = _look_up(merge, target, candidates, merge.changes)
    same = found.join(candidates.select("_sid"), "_sid", "left_anti")
    return same.select(*again.columns).unionAll(again)


def _look_up(merge: _Merge, nearby: DataFrame, matchable: DataFrame, changes: Column) -> DataFrame:
    """Per matched target row: the source row and its keys, whether it changes, and the other values if so."""
    keys = [*merge.source_keys, "_sid"]
    others = [name for name in matchable.columns if name not in keys]
    return (
        nearby.alias("trg")
        .join(matchable.alias("src"), merge.join_match)
        .select(
            *[of("src", name) for name in keys],
            *[F.when(changes, of("src", name)).alias(name) for name in others],
            changes.alias("_changed"),
        )
    )


def _replace(merge: _Merge, rows: DataFrame, changed: DataFrame) -> DataFrame:
    """``rows`` of the target with the changes applied, and their fingerprints."""
    found = changed.withColumn("_found", F.lit(True))
    take = F.coalesce(of("src", "_found"), F.lit(False)) & merge.changes
    replaced = (
        rows.alias("trg")
        .join(found.alias("src"), merge.join_match, "left")
        .select(
            *[
                F.when(take, of("src", merge.set_columns[field.name]).cast(field.dataType))
                .otherwise(of("trg", field.name))
                .alias(field.name)
                if field.name in merge.set_columns
                else of("trg", field.name)
                for field in merge.target.schema
            ]
        )
    )
    return with_fingerprint(replaced, merge.table)


def _as_target(merge: _Merge, new: DataFrame, staged: DataFrame, source_rows: int) -> DataFrame:
    """Source rows in the shape of the target; columns that are not set are NULL, new rows get new numbers."""
    identity = merge.table.identity
    shaped = {
        field.name: F.col(f"`{merge.set_columns[field.name]}`").cast(field.dataType)
        if field.name in merge.set_columns
        else F.lit(None).cast(field.dataType)
        for field in merge.target.schema
    }
    if merge.table.slices:
        shaped[merge.table.slices.column] = merge.partition_values[-1]
    if identity is not None:
        first = _reserve(merge, source_rows)
        # A row's place among all source rows: its task's rows are counted, one number for each task.
        task = F.shiftright("_sid", _ROW_BITS)
        counts = staged.groupBy(task.alias("_task")).agg(F.count("*").alias("_count"))
        before = F.sum("_count").over(Window.orderBy("_task")) - F.col("_count")
        new = new.withColumn("_task", task).join(counts.select("_task", before.alias("_before")), "_task")
        row = F.col("_sid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        shaped[identity] = F.lit(first) + F.col("_before") + row
    return with_fingerprint(new.select(*(column.alias(name) for name, column in shaped.items())), merge.table)


def _reserve(merge: _Merge, count: int) -> int:
    """The first of ``count`` numbers that no row of the table has. They are taken before any row is written.

    The highest number taken lies in a folder beside the table, one small row for each upsert. Only a table
    that was filled in another way is scanned for it, once. Two writers can't take the same numbers: see :func:`_claim`.
    """
    spark = merge.target.sparkSession
    taken = f"{merge.table.path.rstrip('/')}_numbers"
    for attempt in count_up():
        given = _if_there(spark.read.schema("last long").option("recursiveFileLookup", True), taken)
        last = given.agg(F.max("last")).first()[0] if given is not None else None
        if last is None:
            last = merge.target.agg(F.max(f"`{merge.table.identity}`")).first()[0] or 0
        # Writers that go on in step would collide again and again: from the third try on each leaves a gap of its own.
        first = last + 1 + count * random.randrange(2 ** min(max(attempt - 1, 0), 10))
        if _claim(spark, taken, first, first + count - 1):
            return first
        time.sleep(random.uniform(0, 0.5 * 2 ** min(attempt, 6)))


def _claim(spark: SparkSession, taken: str, first: int, last: int) -> bool:
    """Take the numbers from ``first`` to ``last``; tell whether nobody else took one of them.

    A claim is a folder that nobody else writes. After it is there, all claims are read: of two writers that claim the
    same numbers at least the later one sees the other, and a writer that sees another one gives its numbers up. They
    stay taken, so nobody may get them then.
    """
    claimant = uuid.uuid4().hex
    row = spark.createDataFrame([(first, last, claimant)], "first long, last long, claimant string")
    row.coalesce(1).write.parquet(f"{taken}/claim-{claimant}")
    claims = spark.read.schema(row.schema).option("recursiveFileLookup", True).parquet(taken)
    others = claims.filter((F.col("first") <= last) & (F.col("last") >= first) & (F.col("claimant") != claimant))
    return others.isEmpty()
