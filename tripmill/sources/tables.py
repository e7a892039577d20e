"""Tables at a path, with or without a catalog entry.

Everything goes through readers, writers, SQL and the catalog, so it also runs in sessions that have no access to
the driver's JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.errors import PartitionColumnError, TableMismatchError


@dataclass(frozen=True)
class Slices:
    """Parts of a partition: what an update rewrites where a row changes.

    A slice follows from the columns ``by``: from their hash, if ``count`` is given, or from the span of ``seconds``
    that one time column falls in. Spans suit batches of neighbouring times, hashes spread any batch evenly. The number
    is stored as one more partition column, ``column``, which readers of the table do not see.
    """

    by: tuple[str, ...]
    count: int | None = None
    seconds: int | None = None
    column: str = "row_slice"

    def __post_init__(self) -> None:
        if not self.by or (self.count is None) == (self.seconds is None) or (self.count if self.seconds is None else self.seconds) < 1:
            raise ValueError("slices need columns, and a count of hashes or a span in seconds")
        if self.seconds is not None and len(self.by) != 1:
            raise ValueError("spans are of one time column")

    def value(self, column_of: Callable[[str], Column], types: dict[str, T.DataType]) -> Column:
        """The slice of a row whose columns ``column_of`` gives by name, as values of ``types``."""
        columns = [column_of(name).cast(types[name]) for name in self.by]
        if self.count is not None:
            return F.pmod(F.xxhash64(*columns), F.lit(self.count)).cast("int").alias(self.column)
        moment, data_type = columns[0], types[self.by[0]]
        if isinstance(data_type, T.DateType):
            seconds = F.unix_date(moment).cast("long") * 86_400
        elif isinstance(data_type, T.TimestampNTZType):
            # A cast to a zoned time would make the slice depend on the session's zone.
            seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), moment)
        elif isinstance(data_type, T.TimestampType):
            seconds = F.unix_seconds(moment)
        else:
            raise PartitionColumnError(f"{self.by[0]} is no time column")
        return F.floor(seconds / self.seconds).cast("int").alias(self.column)


@dataclass(frozen=True)
class Table:
    """A table: its folder, and optionally its catalog name, partition, surrogate key and cluster columns.

    Each write is sorted by the cluster columns within its partitions, so that a file, and a row group in it,
    holds a narrow range of them. ``format`` is ``parquet``, or a catalog format with a MERGE of its own, which
    an upsert then uses; such a table needs a name, and its own way of creation.

    ``schema`` is for tables without a name whose partition values look like another type than they are:
    by default Spark reads the types of partition columns off the folder names.

    ``slices`` divide partitions further, so that an update of few rows does not rewrite whole partitions.

    ``fingerprint`` names a column with a hash of each row, so that an upsert that sets all columns reads keys and one
    number to find what has not changed. It is stored with each row and hidden from readers of the table. A row without
    one, as of files written in another way, is compared column by column.
    """

    path: str
    partition_by: tuple[str, ...] = ()
    identity: str | None = None
    name: str | None = None
    schema: T.StructType | None = None
    cluster_by: tuple[str, ...] = ()
    format: str = "parquet"
    slices: Slices | None = None
    fingerprint: str | None = None

    @property
    def hidden(self) -> tuple[str, ...]:
        """Stored columns that readers of the table do not see."""
        return (*((self.slices.column,) if self.slices else ()), *((self.fingerprint,) if self.fingerprint else ()))

    @property
    def stored_by(self) -> tuple[str, ...]:
        """The partition columns as they are stored: with the slice, if there are slices."""
        return (*self.partition_by, self.slices.column) if self.slices else self.partition_by

    @property
    def switchable(self) -> bool:
        """Whether a catalog holds the place of each partition, so that a partition can be pointed to a new folder."""
        return self.name is not None and bool(self.stored_by) and self.format == "parquet"


def quoted(name: str) -> str:
    """``name`` as an SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def table_ddl(schema: T.StructType, identity: str | None = None) -> str:
    """The column list of a CREATE TABLE; the surrogate key, if any, comes first as a bigint."""
    fields = [T.StructField(identity, T.LongType())] if identity else []
    return ", ".join(
        f"{quoted(field.name)} {field.dataType.simpleString()}" for field in [*fields, *schema.fields]
    )


def ensure_table(spark: SparkSession, schema: T.StructType, table: Table) -> Table:
    """Create the catalog table ``table.name`` at ``table.path`` unless it exists.

    Files that lie at the path already become rows of the new table. A table of this name at another path is
    refused, because rows would be written to one place and read from the other. A table that is there is made to
    fit: columns it lacks are added, and its old rows have NULL there. What can't be made to fit raises
    :class:`~tripmill.errors.TableMismatchError`: a column of another type, other partition columns. Columns that only
    the table has stay. Names are compared without regard to case.

    Parquet tables cannot number rows by themselves, so the surrogate key is a plain bigint that
    :func:`~tripmill.operators.upsert` fills. Spark lists partition columns last.
    """
    if table.name is None:
        raise ValueError("a catalog table needs a name")
    known = {name.lower() for name in schema.names}
    needed = (*table.partition_by, *(table.slices.by if table.slices else ()))
    unknown = [name for name in needed if name.lower() not in known]
    if unknown:
        raise PartitionColumnError(f"not columns of the table: {unknown}")
    schema = _with_hidden(schema, table)

    if spark.catalog.tableExists(table.name):
        details = spark.sql(f"DESCRIBE FORMATTED {table.name}")
        location = details.filter("col_name = 'Location'").first()["data_type"]
        if not _same_place(location, table.path):
            raise ValueError(f"table {table.name} lies at {location}, not at {table.path}")
        _reconcile(spark, schema, table)
        return table

    partitioned = ""
    if table.stored_by:
        partitioned = f"PARTITIONED BY ({', '.join(map(quoted, table.stored_by))})"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.name} ({table_ddl(schema, table.identity)}) "
        f"USING {table.format} {partitioned} LOCATION {_text_literal(table.path)}"
    )
    if table.stored_by and _has_files(spark, table.path):
        spark.catalog.recoverPartitions(table.name)
    return table


def _reconcile(spark: SparkSession, schema: T.StructType, table: Table) -> None:
    """Add the columns that the catalog table lacks; raise where types or partitioning differ."""
    partitioned = [column.name.lower() for column in spark.catalog.listColumns(table.name) if column.isPartition]
    if partitioned != [name.lower() for name in table.stored_by]:
        raise TableMismatchError(f"table {table.name} is partitioned by {partitioned}, not by {list(table.stored_by)}")
    there = {field.name.lower(): field.dataType for field in spark.table(table.name).schema}
    wanted = [T.StructField(table.identity, T.LongType())] if table.identity else []
    missing = []
    for field in [*wanted, *schema.fields]:
        data_type = there.get(field.name.lower())
        if data_type is None:
            missing.append(field)
        elif data_type.simpleString() != field.dataType.simpleString():
            raise TableMismatchError(
                f"column {field.name} of {table.name} is {data_type.simpleString()}, not {field.dataType.simpleString()}"
            )
    if missing:
        spark.sql(f"ALTER TABLE {table.name} ADD COLUMNS ({table_ddl(T.StructType(missing))})")


def _same_place(one: str, other: str) -> bool:
    """Whether two paths name one folder. A path without a scheme is on the file system of the other one."""
    (scheme, path), (other_scheme, other_path) = (_split_path(text) for text in (one, other))
    return path == other_path and (scheme == other_scheme or "" in (scheme, other_scheme))


def _split_path(text: str) -> tuple[str, str]:
    """The file system (``file:`` without a host, ``hdfs://host``) and the path on it."""
    scheme, colon, rest = text.partition(":")
    if not colon or "/" in scheme:
        scheme, rest = "", text
    host = ""
    if rest.startswith("//"):
        host, _, rest = rest[2:].partition("/")
    path = "/" + rest.strip("/")
    return (f"{scheme}://{host}" if host else scheme), path


def _has_files(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False


def read_table(spark: SparkSession, table: Table) -> DataFrame:
    """The table, through the catalog if it has a name there, else by path."""
    return stored_rows(spark, table).drop(*table.hidden)


def stored_rows(spark: SparkSession, table: Table) -> DataFrame:
    """The table with all columns it is stored by."""
    if table.name:
        return spark.table(table.name)
    reader = spark.read.schema(_with_hidden(table.schema, table)) if table.schema else spark.read
    return reader.parquet(table.path)


def _with_hidden(schema: T.StructType, table: Table) -> T.StructType:
    hidden = []
    if table.fingerprint:
        hidden.append(T.StructField(table.fingerprint, T.LongType()))
    if table.slices:
        hidden.append(T.StructField(table.slices.column, T.IntegerType()))
    return T.StructType([*schema.fields, *(field for field in hidden if field.name not in schema.names)])


def hashed_columns(table: Table, names: Sequence[str]) -> list[str]:
    """Of a table's columns those that its fingerprint covers, in the order they are hashed in."""
    left_out = {name.lower() for name in (*table.partition_by, *table.hidden, table.identity or "")}
    return sorted((name for name in names if name.lower() not in left_out), key=str.lower)


def row_hash(columns: Sequence[Column]) -> Column:
    """A hash of values in order. NULL leaves a hash as it is, so whether a value is there is hashed as well."""
    return F.xxhash64(*(part for column in columns for part in (column, column.isNull())))


def with_fingerprint(df: DataFrame, table: Table) -> DataFrame:
    """``df`` with the fingerprint of its rows, if the table has one."""
    if not table.fingerprint:
        return df
    df = df.drop(table.fingerprint)
    hashed = hashed_columns(table, df.columns)
    kinds = {field.name: field.dataType for field in df.schema}
    maps = [name for name in hashed if "map<" in kinds[name].simpleString()]
    if maps:
        raise ValueError(f"maps have no hash, so a table with {maps} can have no fingerprint")
    return df.withColumn(table.fingerprint, row_hash([F.col(f"`{name}`") for name in hashed]))


def scan_where(spark: SparkSession, source: str, where: str | None = None) -> DataFrame:
    """Rows of a catalog table, or of files given as ``parquet.`path```, for which ``where`` holds."""
    rows = spark.table(source)
    return rows.where(where) if where else rows


def write_table(df: DataFrame, table: Table, mode: str = "overwrite") -> None:
    """Write ``df`` to the table's folder.

    ``mode`` is ``overwrite`` (the whole table), ``append``, or ``partitions``: replace those partitions
    that ``df`` has rows for and leave the others alone. ``df`` must not read from the table itself.

    A partitioned table with a name is written through the catalog, which knows where each partition lies and
    learns of new ones.

    Rows are brought together by partition before the write, or every task would open a file in every
    partition. With cluster columns they are dealt by ranges of (partition, cluster columns) and sorted, so a
    large partition is many narrow ranges. Without, ``rebalance`` does it by size: small partitions share a task
    and a large one is split over many. That splitting is adaptive execution's; with it off, a partition is
    written by one task.
    """
    if mode not in ("overwrite", "append", "partitions"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "partitions" and not table.stored_by:
        raise PartitionColumnError("the table has no partitions to replace")
    spark = df.sparkSession
    df = dealt_by_partition(df, table)
    dynamic = "dynamic" if mode == "partitions" else "static"
    with timestamps_with_statistics(spark):
        if table.switchable:
            with _setting(spark, "spark.sql.sources.partitionOverwriteMode", dynamic):
                ordered = df.select(*(quoted(name) for name in spark.table(table.name).columns))
                ordered.write.insertInto(table.name, overwrite=mode != "append")
        else:
            writer = df.write.mode("append" if mode == "append" else "overwrite")
            writer.option("partitionOverwriteMode", dynamic).partitionBy(*table.stored_by).parquet(table.path)
    if table.name is None:
        spark.catalog.refreshByPath(table.path)
    else:
        spark.catalog.refreshTable(table.name)


def dealt_by_partition(df: DataFrame, table: Table) -> DataFrame:
    """``df`` with its slice, brought together by partition and, with cluster columns, sorted by them."""
    if table.slices and table.slices.column not in df.columns:
        types = {field.name: field.dataType for field in df.schema}
        df = df.withColumn(table.slices.column, table.slices.value(lambda name: F.col(f"`{name}`"), types))
    if table.fingerprint and table.fingerprint not in df.columns:
        df = with_fingerprint(df, table)
    if table.cluster_by:
        order = [F.col(f"`{name}`") for name in (*table.stored_by, *table.cluster_by)]
        return df.repartitionByRange(*order).sortWithinPartitions(*order)
    return df.hint("rebalance", *table.stored_by) if table.stored_by else df


def point_partitions(spark: SparkSession, table: Table, places: Sequence[tuple[tuple, str]]) -> None:
    """Point partitions, given by their values as text, to the folders that hold their rows from now on.

    One catalog call for each, so each partition changes at once and as a whole.
    """
    for values, folder in places:
        spec = _partition_spec(table.stored_by, values)
        spark.sql(f"ALTER TABLE {table.name} {spec} SET LOCATION {_text_literal(folder)}")
    spark.catalog.refreshTable(table.name)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def timestamps_with_statistics(spark: SparkSession) -> Iterator[None]:
    """Spark's default for timestamps in parquet, INT96, has no minimum and maximum to skip row groups by.

    The format is a session setting and no option of a single write, so it is put back afterwards. Another
    thread that writes in the same session meanwhile writes this format too.
    """
    with _setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS"):
        yield


def _partition_spec(columns: Sequence[str], values: tuple) -> str:
    return "PARTITION (" + ", ".join(f"{quoted(c)}={_literal(v)}" for c, v in zip(columns, values)) + ")"


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, (bool, int, float)):
        return str(value)
    return _text_literal(str(value))


def _text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
