"""One query per operator and plan, each over the whole test tables.

A query is called with a session and the folder of the tables. ``oracles.py`` has the same results in SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators import (
    UpsertReport,
    add_calendar_parts,
    add_constants,
    add_duration_minutes,
    assign_surrogate_key,
    classify,
    clean,
    dedup_by_key,
    rename_columns,
    touched_partitions,
    union_feeds,
    upsert,
)
from tripmill.plans import MERGE_KEYS, TRIP_KEYS, conform_feeds, run_month, to_trips, trip_table
from tripmill.plans.monthly import RAW_TYPES, TRIP_SCHEMA
from tripmill.plans.trips import (
    RAW_DEFAULTS,
    RAW_FILTER,
    RAW_REQUIRED,
    TRIP_DEFAULTS,
    TRIP_FILTER,
    TRIP_REQUIRED,
    typed_feed,
)
from tripmill.scratch import new_folder, stage
from tripmill.sources import (
    Slices,
    Table,
    ensure_table,
    read_delimited,
    read_or_quarantine,
    read_table,
    scan_where,
    write_table,
)
from tripmill.sources.sample_feeds import sample_feed


def _read(spark: SparkSession, tables: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{tables}/{name}.parquet")


def _conformed(spark: SparkSession, tables: str) -> DataFrame:
    return conform_feeds(sample_feed(spark, tables, "green"), sample_feed(spark, tables, "yellow"))


def _trips(spark: SparkSession, tables: str) -> DataFrame:
    return to_trips(_conformed(spark, tables))


# ---- sources and tables


def table_scan_filter(spark: SparkSession, tables: str) -> DataFrame:
    """Rows of a table by an equality in SQL text."""
    return scan_where(spark, f"parquet.`{tables}/region.parquet`", "r_regionkey = 0")


def _write_delimited(df: DataFrame, path: str, separator: str) -> str:
    """Write gzip parts with a header, in a folder that can be read like a file."""
    writer = df.write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    writer.csv(path, header=True, sep=separator, compression="gzip")
    return path


def csv_roundtrip(spark: SparkSession, tables: str) -> DataFrame:
    """Orders written as gzip text with ``;``, and some columns of it read back with given types."""
    path = new_folder(spark, "orders") + ".csv.gz"
    _write_delimited(_read(spark, tables, "orders"), path, ";")
    types = {
        "o_orderkey": T.LongType(),
        "o_totalprice": T.DoubleType(),
        "o_orderdate": T.TimestampNTZType(),
    }
    columns = ["o_orderdate", "o_orderkey", "o_orderpriority", "O_TotalPrice"]
    return read_delimited(spark, path, columns, types, separator=";")


def csv_inferred_types(spark: SparkSession, tables: str) -> DataFrame:
    """Customers written as gzip text and read back by a glob, with types found by Spark."""
    folder = new_folder(spark, "customers")
    _write_delimited(_read(spark, tables, "customer"), f"{folder}/customer_all.csv.gz", ",")
    columns = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return read_delimited(spark, f"{folder}/customer_*.csv.gz", columns)


def feeds_by_header(spark: SparkSession, tables: str) -> DataFrame:
    """Customers delivered in two files that name their columns in another order, read as one table."""
    folder = new_folder(spark, "customers-by-header")
    customers = _read(spark, tables, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    odd = F.col("c_custkey") % 2 == 1
    _write_delimited(customers.filter(odd), f"{folder}/customer_odd.csv.gz", ",")
    _write_delimited(customers.filter(~odd).select(*reversed(customers.columns)), f"{folder}/customer_even.csv.gz", ",")
    types = {"c_custkey": T.LongType(), "c_acctbal": T.DoubleType()}
    return read_delimited(spark, f"{folder}/customer_*.csv.gz", ["c_name", "c_custkey", "c_acctbal"], types)


def dirty_lines(spark: SparkSession, tables: str) -> DataFrame:
    """All order lines delivered as text, some with a field too few or too many, or a value that is none.

    Every line is either loaded, or set aside with the reason.
    """
    path = new_folder(spark, "dirty-lines") + ".csv.gz"
    kind = (F.col("l_orderkey") + F.col("l_linenumber")) % 10
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"]
    quantity = F.when(kind == 1, F.lit("many")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    day = F.when(kind == 4, F.lit("2025-13-45")).otherwise(F.col("l_shipdate").cast("date").cast("string"))
    line = F.concat_ws(
        ",", "l_orderkey", "l_linenumber", quantity, F.when(kind != 2, day), F.when(kind == 3, F.lit("x"))
    )
    # One column without quotes, whose name is the header, gives each file its header and the lines as they are.
    text = _read(spark, tables, "lineitem").select(line.alias(",".join(names)))
    text.write.csv(path, header=True, sep="\u0001", quote="", compression="gzip")
    types = dict(zip(names, (T.LongType(), T.IntegerType(), T.IntegerType(), T.DateType())))
    loaded, aside = read_or_quarantine(spark, path, names, types)
    loaded = loaded.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
    return loaded.unionByName(aside.drop("file"), allowMissingColumns=True)


def table_overwrite(spark: SparkSession, tables: str) -> DataFrame:
    """A table written twice to the same folder; the second content replaces the first."""
    table = Table(new_folder(spark, "overwrite"))
    write_table(_read(spark, tables, "supplier"), table)
    write_table(_read(spark, tables, "customer"), table)
    return read_table(spark, table)


def partitioned_table_read(spark: SparkSession, tables: str) -> DataFrame:
    """Orders in a catalog table partitioned by year; the years that late orders fall in are read back."""
    orders = add_calendar_parts(_read(spark, tables, "orders"), "o_orderdate", "Order")
    table = Table(
        path=new_folder(spark, "orders-by-year"),
        partition_by=("OrderYear",),
        name=f"tripmill_orders_{uuid.uuid4().hex}",
    )
    ensure_table(spark, orders.schema, table)
    write_table(orders, table)
    late = scan_where(spark, table.name, "o_orderdate >= '2000-06-01'")
    years = stage(touched_partitions(late, ["OrderYear"]), new_folder(spark, "years"))
    # The files are not the catalog's, so dropping its entry leaves them to be read by path.
    spark.sql(f"DROP TABLE {table.name}")
    return read_table(spark, replace(table, name=None)).join(years, "OrderYear", "left_semi")


def surrogate_key(spark: SparkSession, tables: str) -> DataFrame:
    """Orders numbered in the order of their key."""
    orders = _read(spark, tables, "orders").select("o_orderkey", "o_totalprice")
    return assign_surrogate_key(orders, "sk_order", ["o_orderkey"])


# ---- columns, cleaning, derived columns


def renamed_columns(spark: SparkSession, tables: str) -> DataFrame:
    """Two columns swap names, one gets a new name, and a pair without a column is ignored."""
    lines = _read(spark, tables, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    return rename_columns(
        lines,
        ["l_tax", "l_discount", "l_linenumber", "no_column"],
        ["l_discount", "l_tax", "line", "x"],
    )


def constant_columns(spark: SparkSession, tables: str) -> DataFrame:
    """Orders with five constants."""
    orders = _read(spark, tables, "orders").select("o_orderkey")
    names = ["col1", "col2", "col3", "col4", "col5"]
    return add_constants(orders, names, ["abc", 999, "2040-01-01", True, 0.01])


def read_feeds_union(spark: SparkSession, tables: str) -> DataFrame:
    """Both feeds in one table with one set of names."""
    return _conformed(spark, tables)


def union_by_position(spark: SparkSession, tables: str) -> DataFrame:
    """Two tables with other names and types put under each other; int and double give double."""
    customers = _read(spark, tables, "customer").select("c_name", "c_nationkey")
    suppliers = _read(spark, tables, "supplier").select("s_name", "s_acctbal")
    return union_feeds(customers, suppliers, by_position=True)


def clean_trips(spark: SparkSession, tables: str) -> DataFrame:
    """Both feeds cleaned by the rules of the monthly run: a trip needs a pickup location."""
    return clean(_conformed(spark, tables), TRIP_FILTER, TRIP_REQUIRED, TRIP_DEFAULTS)


def clean_trips_both_locations(spark: SparkSession, tables: str) -> DataFrame:
    """Both raw feeds cleaned by the default rules: a trip needs both locations."""
    times = ["pickup_datetime", "dropoff_datetime"]
    yellow = rename_columns(
        sample_feed(spark, tables, "yellow"), [f"tpep_{name}" for name in times], [f"lpep_{name}" for name in times]
    )
    both = union_feeds(
        add_constants(sample_feed(spark, tables, "green"), ["TripMode"], ["Green"]),
        add_constants(yellow, ["TripMode"], ["Yellow"]),
    )
    return clean(both, RAW_FILTER, RAW_REQUIRED, RAW_DEFAULTS)


def dirty_feeds(spark: SparkSession, tables: str) -> DataFrame:
    """Both feeds with codes and counts as text, some of it ``1.0``, ``x`` or empty, read as their types."""
    times = ["pickup_datetime", "dropoff_datetime"]
    yellow = rename_columns(
        sample_feed(spark, tables, "yellow"), [f"tpep_{name}" for name in times], [f"lpep_{name}" for name in times]
    )
    feed = union_feeds(sample_feed(spark, tables, "green"), yellow)
    kind = F.coalesce("RatecodeID", F.lit(0)) % 5
    made = {}
    for name in ("passenger_count", "payment_type", "trip_distance"):
        text = F.col(name).cast("string")
        made[name] = (
            F.when(kind == 1, F.concat(F.col(name).cast("int").cast("string"), F.lit(".0")))
            .when(kind == 2, F.lit("x"))
            .when(kind == 3, F.lit(""))
            .otherwise(text)
        )
    text_feed = feed.withColumns(made)
    _, bad = typed_feed(text_feed, RAW_TYPES)
    typed, _ = typed_feed(text_feed.withColumn("unreadable", bad), RAW_TYPES)
    return typed.select("lpep_pickup_datetime", "RatecodeID", *made, "unreadable")


def distinct_rows(spark: SparkSession, tables: str) -> DataFrame:
    """Which user had which kind of event; only the duplicates go."""
    return clean(_read(spark, tables, "events").select("user_id", "event_type"))


def calendar_parts(spark: SparkSession, tables: str) -> DataFrame:
    """Year, month and day of a timestamp."""
    orders = _read(spark, tables, "orders").select("o_orderkey", "o_orderdate")
    return add_calendar_parts(orders, "o_orderdate", "Order")


def _dirty(moment: Column) -> Column:
    """``moment`` as text, broken in a way that depends on the line number."""
    text = moment.cast("string")
    broken = {
        2: F.lit("2025-13-45"),
        3: F.concat(F.lit("xx"), F.substring(text, 1, 10), F.lit("yy")),
        4: F.substring(text, 1, 10),
        5: F.lit("XQDS"),
        6: F.concat(text, F.lit(".123")),
        7: F.lit(None).cast("string"),
    }
    dirty = text
    for line, value in broken.items():
        dirty = F.when(F.col("l_linenumber") == line, value).otherwise(dirty)
    return dirty


def _dirty_times(spark: SparkSession, tables: str) -> DataFrame:
    pickup = F.col("l_shipdate")
    drop = pickup + (F.col("l_partkey") % 5000 - 100) * F.expr("INTERVAL '1' SECOND")
    lines = _read(spark, tables, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", _dirty(pickup).alias("PickupTime"), drop.cast("string").alias("DropTime")
    )


def calendar_parts_dirty_text(spark: SparkSession, tables: str) -> DataFrame:
    """Year, month and day of text that does not always hold a date."""
    return add_calendar_parts(_dirty_times(spark, tables).drop("DropTime"), "PickupTime", "Trip")


def trip_duration(spark: SparkSession, tables: str) -> DataFrame:
    """Minutes of every trip of both feeds."""
    times = _conformed(spark, tables).select("PickupTime", "DropTime")
    return add_duration_minutes(times, "TripTimeInMinutes")


def trip_duration_dirty_text(spark: SparkSession, tables: str) -> DataFrame:
    """Minutes between text times that do not always hold one; some trips end before they start."""
    return add_duration_minutes(_dirty_times(spark, tables), "TripTimeInMinutes")


def trip_type(spark: SparkSession, tables: str) -> DataFrame:
    """Shared or solo, by rate code; a missing code is solo."""
    return classify(_conformed(spark, tables).select("TripMode", "PickupTime", "RatecodeID"), "TripType")


# ---- one row per key


def _keyed(spark: SparkSession, tables: str) -> DataFrame:
    return classify(clean(_conformed(spark, tables), defaults=TRIP_DEFAULTS, distinct=False), "TripType")


def trips_by_key(spark: SparkSession, tables: str) -> DataFrame:
    """The last row per business key, trips not cleaned before."""
    return dedup_by_key(_keyed(spark, tables), TRIP_KEYS, ["PickupTime"])


def trips_by_key_asc(spark: SparkSession, tables: str) -> DataFrame:
    """The first row per business key, cheapest first."""
    return dedup_by_key(_keyed(spark, tables), TRIP_KEYS, ["TotalAmount"], ascending=True)


def trips_by_key_per_feed(spark: SparkSession, tables: str) -> DataFrame:
    """The last row per business key of each feed by itself; the feeds are put together afterwards."""
    keyed = _keyed(spark, tables)
    keys = [name for name in TRIP_KEYS if name != "TripMode"]
    green, yellow = (
        dedup_by_key(keyed.filter(F.col("TripMode") == mode), keys, ["PickupTime"]) for mode in ("Green", "Yellow")
    )
    return union_feeds(green, yellow)


def busiest_key(spark: SparkSession, tables: str) -> DataFrame:
    """One row per key where very few keys hold all the rows: the dearest trip per mode and type."""
    return dedup_by_key(_keyed(spark, tables), ["TripMode", "TripType"], ["TotalAmount", "PickupTime"])


# ---- upsert

_TARGET_UNTIL = _SOURCE_FROM = 1999


def _upsert_sides(spark: SparkSession, tables: str) -> tuple[DataFrame, Table]:
    """Trips from 1999 on as source, some at another price; a table with the trips until 1999."""
    trips = stage(_trips(spark, tables), new_folder(spark, "trips"))
    table = Table(
        new_folder(spark, "trip-table"),
        ("TripYear", "TripMonth"),
        name=f"tripmill_trips_{uuid.uuid4().hex}",
        cluster_by=("PickupTime",),
    )
    ensure_table(spark, trips.schema, table)
    write_table(trips.filter(F.col("TripYear") <= _TARGET_UNTIL), table)
    dearer = F.col("TotalAmount") + F.when(F.col("VendorID") == 1, 1.0).otherwise(0.0)
    return trips.filter(F.col("TripYear") >= _SOURCE_FROM).withColumn("TotalAmount", dearer), table


def _upserted(spark: SparkSession, tables: str, runs: int, null_safe: bool) -> DataFrame:
    source, table = _upsert_sides(spark, tables)
    for _ in range(runs):
        upsert(source, table, MERGE_KEYS, null_safe_keys=null_safe)
    return read_table(spark, table)


def upsert_trips(spark: SparkSession, tables: str) -> DataFrame:
    """The table after one upsert."""
    return _upserted(spark, tables, runs=1, null_safe=False)


def upsert_trips_rerun(spark: SparkSession, tables: str) -> DataFrame:
    """The table after the same upsert twice: rows with a NULL key are there twice."""
    return _upserted(spark, tables, runs=2, null_safe=False)


def upsert_null_safe(spark: SparkSession, tables: str) -> DataFrame:
    """The table after one upsert for which NULL keys are equal."""
    return _upserted(spark, tables, runs=1, null_safe=True)


def upsert_null_safe_rerun(spark: SparkSession, tables: str) -> DataFrame:
    """The table after the same upsert twice, NULL keys being equal: the same as after one."""
    return _upserted(spark, tables, runs=2, null_safe=True)


def upsert_sliced(spark: SparkSession, tables: str) -> DataFrame:
    """The table after two upserts, in slices of hashes below its years; only slices with a changed row are rewritten."""
    source, months = _upsert_sides(spark, tables)
    table = Table(
        new_folder(spark, "sliced-trips"),
        ("TripYear",),
        name=f"tripmill_sliced_{uuid.uuid4().hex}",
        slices=Slices(("PickupTime",), count=4),
    )
    ensure_table(spark, source.schema, table)
    keys = [name for name in MERGE_KEYS if name != "TripMonth"]
    upsert(read_table(spark, months), table, keys)
    upsert(source, table, keys)
    return read_table(spark, table)


def upsert_mapped(spark: SparkSession, tables: str) -> DataFrame:
    """The table after an upsert from a source with other names, by a condition as text."""
    source, table = _upsert_sides(spark, tables)
    columns = {name: f"new_{name}" for name in source.columns}
    upsert(
        source.withColumnsRenamed(columns),
        table,
        [(name, columns[name]) for name in MERGE_KEYS],
        columns=columns,
        update_when="trg.TotalAmount < src.new_TotalAmount AND src.new_PaymentType <> 1",
    )
    return read_table(spark, table)


def upsert_numbered(spark: SparkSession, tables: str) -> DataFrame:
    """The numbered table after two upserts: which rows are new, and whether each number is as it should be.

    Numbers must be unique; a row that was there keeps its number, and a new one has a higher one than all old.
    """
    source, plain = _upsert_sides(spark, tables)
    name = f"tripmill_numbered_{uuid.uuid4().hex}"
    table = replace(plain, path=new_folder(spark, "numbered-trips"), name=name, identity="TaxiDataId")
    ensure_table(spark, source.schema, table)
    upsert(read_table(spark, plain), table, MERGE_KEYS, null_safe_keys=True)
    before = stage(read_table(spark, table), new_folder(spark, "before"))
    upsert(source, table, MERGE_KEYS, null_safe_keys=True)
    old = before.select(F.col("TaxiDataId").alias("old_id"), *(F.col(k).alias(f"old_{k}") for k in MERGE_KEYS))
    highest = before.agg(F.max("TaxiDataId").alias("highest"))
    after = read_table(spark, table)
    uses = after.groupBy("TaxiDataId").agg(F.count("*").alias("uses"))
    same = [F.col(k).eqNullSafe(F.col(f"old_{k}")) for k in MERGE_KEYS]
    joined = after.join(uses, "TaxiDataId").join(old, same, "left").join(F.broadcast(highest))
    right = (F.col("uses") == 1) & F.when(
        F.col("old_id").isNull(), F.col("TaxiDataId") > F.col("highest")
    ).otherwise(F.col("TaxiDataId") == F.col("old_id"))
    return joined.select(
        *source.columns, F.col("old_id").isNull().alias("is_new"), F.coalesce(right, F.lit(False)).alias("number_ok")
    )


def upsert_report(spark: SparkSession, tables: str) -> DataFrame:
    """What the first upsert counts."""
    source, table = _upsert_sides(spark, tables)
    report: UpsertReport = upsert(source, table, MERGE_KEYS)
    names = ("source_rows", "matched", "updated", "inserted")
    counts = [tuple(asdict(report)[name] for name in names)]
    return spark.createDataFrame(counts, ", ".join(f"{name} bigint" for name in names))


def merged_partitions(spark: SparkSession, tables: str) -> DataFrame:
    """The partitions that all trips touch."""
    return touched_partitions(_trips(spark, tables), ["TripYear"])


# ---- plans


def conformed_trips(spark: SparkSession, tables: str) -> DataFrame:
    """From both raw feeds to one clean trip per business key."""
    return _trips(spark, tables)


def conformed_trips_both_locations(spark: SparkSession, tables: str) -> DataFrame:
    """The same for trips that have both locations, the cheapest trip of each key."""
    conformed = _conformed(spark, tables)
    required = ["PickupLocationId", "DropLocationId"]
    return to_trips(conformed, required, ["TotalAmount"], ascending=True)


def monthly_run(spark: SparkSession, tables: str) -> DataFrame:
    """Both feeds delivered as gzip text, read by a glob, and loaded into the numbered trip table."""
    landing = new_folder(spark, "landing")
    for service in ("green", "yellow"):
        path = f"{landing}/{service}/{service}_tripdata_all.csv.gz"
        _write_delimited(sample_feed(spark, tables, service), path, ",")
    table = trip_table(f"tripmill_trips_{uuid.uuid4().hex}", new_folder(spark, "trips"))
    run_month(spark, landing, "*", table, RAW_TYPES)
    trips = read_table(spark, table)
    wall_clock = {name: F.col(name).cast("timestamp_ntz") for name in ("PickupTime", "DropTime")}
    return trips.withColumns(wall_clock).select(*TRIP_SCHEMA.names)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        table_scan_filter,
        csv_roundtrip,
        csv_inferred_types,
        feeds_by_header,
        dirty_lines,
        table_overwrite,
        partitioned_table_read,
        surrogate_key,
        renamed_columns,
        constant_columns,
        read_feeds_union,
        union_by_position,
        clean_trips,
        clean_trips_both_locations,
        dirty_feeds,
        distinct_rows,
        calendar_parts,
        calendar_parts_dirty_text,
        trip_duration,
        trip_duration_dirty_text,
        trip_type,
        trips_by_key,
        trips_by_key_asc,
        trips_by_key_per_feed,
        busiest_key,
        upsert_trips,
        upsert_trips_rerun,
        upsert_null_safe,
        upsert_null_safe_rerun,
        upsert_sliced,
        upsert_mapped,
        upsert_numbered,
        upsert_report,
        merged_partitions,
        conformed_trips,
        conformed_trips_both_locations,
        monthly_run,
    )
}
