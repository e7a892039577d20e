"""Delimited text feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import readable, unreadable

# Headers that are read at a time.
_HEADERS = 16
# Columns of the lines that were set aside.
QUARANTINE = ("file", "line", "reason")
_BROKEN, _FILE = "_broken_line", "_file"


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = ("*",),
    types: Mapping[str, T.DataType] | None = None,
    header: bool = True,
    separator: str = ",",
) -> DataFrame:
    """Read delimited text and keep ``columns``.

    ``path`` may be a file, a folder or a glob; compression follows from the suffix (``.csv.gz``). A gzip
    file cannot be split, so it is read by one task: deliver many files rather than a large one.

    Without ``types`` Spark infers them, which reads all the data one extra time. With ``types`` only the
    header lines are read up front: named columns get their type, other columns are text. A whole number written
    as ``1.0`` is read as one, and only a value that cannot be read as its type becomes NULL; to count those, read
    the columns as text and use :func:`~tripmill.functions.unreadable`, to set such lines aside, use
    :func:`read_or_quarantine`. Files may name their columns in different orders: files with one header are one scan,
    and the scans are put together by name. Without ``types`` another order raises.

    Columns are found without regard to case and come out in the spelling asked for. ``*`` takes the columns of the
    first file, in its order, which all files must have then.
    """
    if types is None:
        raw = spark.read.csv(path, header=header, sep=separator, inferSchema=True, enforceSchema=not header)
        return raw.select(*columns)

    wanted = {name.lower(): data_type for name, data_type in types.items()}
    scans = []
    for raw, names in _scans(spark, path, header, separator):
        typed = {
            name: readable(F.col(f"`{name}`"), wanted[name.lower()])
            for name in names
            if not isinstance(wanted.get(name.lower(), T.StringType()), T.StringType)
        }
        scans.append((raw.withColumns(typed) if typed else raw).select(*columns))
    return _together(scans)


def read_or_quarantine(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    types: Mapping[str, T.DataType],
    header: bool = True,
    separator: str = ",",
) -> tuple[DataFrame, DataFrame]:
    """Two tables: the lines that can be read, with their ``columns``, and the others as ``file``, ``line``, ``reason``.

    Each delivered line is in one of the two. A line is set aside if it has more or fewer fields than its header
    (``fields``; the line is then as it was delivered), or if the value of a column of ``types`` is there and can't be
    read as its type (``value of <column>``, the first one; the line is its fields joined anew). All fields are split for
    this, also those of columns that are not asked for. Blank lines are no lines. Otherwise as :func:`read_delimited`.
    """
    wanted = {name.lower(): data_type for name, data_type in types.items()}
    good, bad = [], []
    for raw, names in _scans(spark, path, header, separator, whole_lines=True):
        typed = {name: wanted[name.lower()] for name in names if name.lower() in wanted}
        checks = {name: unreadable(F.col(f"`{name}`"), kind) for name, kind in typed.items() if not isinstance(kind, T.StringType)}
        reason = F.coalesce(
            F.when(F.col(_BROKEN).isNotNull(), F.lit("fields")),
            *(F.when(wrong, F.lit(f"value of {name}")) for name, wrong in checks.items()),
        )
        fields = F.struct(*(F.col(f"`{name}`") for name in names))
        line = F.coalesce(F.col(_BROKEN), F.to_csv(fields, {"sep": separator}))
        judged = raw.withColumn("_reason", reason)
        bad.append(judged.filter("_reason IS NOT NULL").select(F.col(_FILE).alias("file"), line.alias("line"), F.col("_reason").alias("reason")))
        values = {name: readable(F.col(f"`{name}`"), typed[name]) for name in checks}
        kept = judged.filter("_reason IS NULL").drop("_reason", _BROKEN, _FILE)
        good.append((kept.withColumns(values) if values else kept).select(*columns))
    return _together(good), _together(bad)


def read_feeds(
    spark: SparkSession, feeds: Sequence[tuple[str, Sequence[str]]], **options
) -> list[DataFrame]:
    """Read several feeds, given as (path, columns), with the same ``options``."""
    return [read_delimited(spark, path, columns, **options) for path, columns in feeds]


def files_at(spark: SparkSession, path: str) -> DataFrame:
    """The files at a path or glob: ``path``, ``modificationTime`` and ``length``. No file is opened."""
    return spark.read.format("binaryFile").load(path).drop("content")


def _scans(
    spark: SparkSession, path: str, header: bool, separator: str, whole_lines: bool = False
) -> list[tuple[DataFrame, list[str]]]:
    """One scan of text columns for each header among the files, with the names in it; that of the first file first.

    With ``whole_lines``, ``_broken_line`` has a line of another number of fields, and ``_file`` its file.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, names in _headers(spark, path, header, separator):
        by_header.setdefault(tuple(names), []).append(file)
    scans = []
    for names, files in by_header.items():
        fields = [T.StructField(name, T.StringType()) for name in names]
        options = {"header": header, "sep": separator, "enforceSchema": not header}
        if whole_lines:
            fields.append(T.StructField(_BROKEN, T.StringType()))
            # A line's fields are counted only if all of them are split.
            options |= {"columnNameOfCorruptRecord": _BROKEN, "mode": "PERMISSIVE", "columnPruning": False}
        # The one header of all files needs no list of them.
        place = path if len(by_header) == 1 else files
        raw = spark.read.options(**options).schema(T.StructType(fields)).csv(place)
        scans.append((raw.withColumn(_FILE, F.col("_metadata.file_path")) if whole_lines else raw, list(names)))
    return scans


def _headers(spark: SparkSession, path: str, header: bool, separator: str) -> list[tuple[str, list[str]]]:
    """Each file and its column names. Of a file only the first line is read; several are read at a time."""

    def names(place: str) -> list[str]:
        return spark.read.csv(place, header=header, sep=separator).columns

    if not header:
        return [(path, names(path))]
    files = [row["path"] for row in files_at(spark, path).select("path").orderBy("path").collect()]
    if len(files) < 2:
        return [(path, names(path))]
    with ThreadPoolExecutor(_HEADERS) as pool:
        return [(file, found) for file, found in zip(files, pool.map(names, files)) if found]


def _together(scans: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, scans)
