"""Stored row fingerprints."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plans import formatted_plan
from pyspark.sql import functions as F
from test_merge import expected, some_rows

from tripmill.errors import DuplicateSourceKeyError, PartitionColumnError
from tripmill.operators import merge, upsert
from tripmill.scratch import new_folder
from tripmill.sources import Slices, Table, ensure_table, read_table, write_table
from tripmill.sources.tables import row_hash, stored_rows

SCHEMA = "k int, a string, b string, c double, y int"
DATA = [(1, "x", None, 0.0, 1), (2, None, "x", 1.5, 1), (3, "p", "q", None, 2)]


def table_of(spark, folder, name=None, **options):
    table = Table(folder, ("y",), fingerprint="row_hash", name=name, **options)
    if name:
        ensure_table(spark, spark.createDataFrame([], SCHEMA).schema, table)
    write_table(spark.createDataFrame(DATA, SCHEMA), table)
    return table


def hashes_fit(spark, table):
    """Every stored fingerprint is that of its row."""
    stored = stored_rows(spark, table)
    return stored.filter(F.col("row_hash") == row_hash([F.col(name) for name in ("a", "b", "c", "k")])).count() == stored.count()


@pytest.mark.parametrize("named", [False, True])
def test_readers_do_not_see_it_and_updates_keep_it(spark, folder, schema_name, named):
    table = table_of(spark, folder, f"{schema_name}.t" if named else None)
    assert set(read_table(spark, table).columns) == {"k", "a", "b", "c", "y"} and hashes_fit(spark, table)
    batch = [(1, "x", None, -0.0, 1), (2, None, "new", 1.5, 1), (4, "n", "n", 2.0, 2)]
    report = upsert(spark.createDataFrame(batch, SCHEMA), table, ["k", "y"])
    assert (report.matched, report.updated, report.inserted) == (2, 1, 1)
    assert report.rewritten_partitions == (("1",),)
    assert hashes_fit(spark, table) and read_table(spark, table).count() == 4


def test_a_swap_of_null_and_value_is_a_change(spark, folder):
    table = table_of(spark, folder)
    batch = spark.createDataFrame([(1, None, "x", 0.0, 1)], SCHEMA)
    assert upsert(batch, table, ["k", "y"], null_safe_compare=True).updated == 1
    assert upsert(batch, table, ["k", "y"], null_safe_compare=True).updated == 0


@pytest.mark.parametrize("null_safe", [False, True])
def test_null_keeps_its_meaning(spark, folder, null_safe):
    table = table_of(spark, folder)
    batch = spark.createDataFrame([(1, "x", "was null", 0.0, 1), (2, None, "x", None, 1), (3, "p", "q", None, 2)], SCHEMA)
    report = upsert(batch, table, ["k", "y"], null_safe_compare=null_safe)
    assert (report.matched, report.updated) == (3, 2 if null_safe else 0)


def test_the_look_up_reads_keys_and_one_number(spark, folder):
    table = table_of(spark, folder)
    batch = spark.createDataFrame(DATA, SCHEMA).withColumn("_sid", F.monotonically_increasing_id())
    plan = merge._resolve(batch.drop("_sid"), table, ["k", "y"], None, None, False, False)
    assert plan.by_fingerprint
    found = merge._look_up(plan, plan.target, batch, plan.may_change)
    scan = next(part for part in formatted_plan(found).split("\n\n") if "Location" in part and folder in part)
    assert "ReadSchema: struct<k:int,row_hash:bigint>" in scan
    assert found.filter("_changed").count() == 0


def test_other_conditions_and_parts_of_a_row_do_without(spark, folder):
    table = table_of(spark, folder)
    batch = spark.createDataFrame([(1, "new", "new", 9.0, 1)], SCHEMA)
    for options in ({"columns": ["k", "y", "a"]}, {"update_when": "trg.c < src.c"}):
        keys = {"update_when": None, "columns": None} | options
        assert not merge._resolve(batch, table, ["k", "y"], keys["columns"], keys["update_when"], False, False).by_fingerprint
    assert upsert(batch, table, ["k", "y"], columns=["k", "y", "a"]).updated == 1
    assert hashes_fit(spark, table)
    assert [(row["a"], row["c"]) for row in read_table(spark, table).filter("k = 1").collect()] == [("new", 0.0)]


def test_rows_without_one_are_compared(spark, folder):
    table = table_of(spark, folder)
    spark.createDataFrame([(7, "x", "y", 1.0, 1), (8, "x", "y", 1.0, 1)], SCHEMA).write.mode("append").partitionBy("y").parquet(folder)
    given = Table(folder, ("y",), fingerprint="row_hash", schema=spark.createDataFrame([], SCHEMA).schema)
    batch = spark.createDataFrame([(7, "x", "y", 1.0, 1), (8, "x", "z", 1.0, 1)], SCHEMA)
    report = upsert(batch, given, ["k", "y"])
    assert (report.matched, report.updated) == (2, 1)
    assert hashes_fit(spark, given)


def test_with_slices_numbers_and_errors(spark, folder, schema_name):
    table = Table(folder, name=f"{schema_name}.s", identity="sk", fingerprint="row_hash", slices=Slices(("k",), count=2))
    ensure_table(spark, spark.createDataFrame([], "k int, v int").schema, table)
    upsert(spark.createDataFrame([(n, 0) for n in range(10)], "k int, v int"), table, ["k"])
    report = upsert(spark.createDataFrame([(n, n // 9) for n in range(11)], "k int, v int"), table, ["k"])
    assert (report.matched, report.updated, report.inserted) == (10, 1, 1)
    assert read_table(spark, table).columns == ["sk", "k", "v"]
    with pytest.raises(PartitionColumnError, match="follows from"):
        upsert(spark.createDataFrame([(1, 1, 1)], "k int, v int, row_hash int"), table, ["k"])
    with pytest.raises(ValueError, match="maps"):
        write_table(spark.sql("SELECT 1 AS k, map('a', 1) AS m"), Table(new_folder(spark, "m"), fingerprint="row_hash"))


@settings(max_examples=6, deadline=None)
@given(target_rows=some_rows, source_rows=some_rows, null_safe=st.booleans())
def test_same_as_brute_force(spark, target_rows, source_rows, null_safe):
    schema = spark.createDataFrame([], "k int, v int, p int").schema
    table = Table(new_folder(spark, "property"), ("p",), schema=schema, fingerprint="row_hash")
    write_table(spark.createDataFrame([(k, v, p) for k, p, v in target_rows], schema), table)
    batch = spark.createDataFrame([(k, v, p) for k, p, v in source_rows], schema)
    want = expected(target_rows, source_rows, null_safe)
    if want is None:
        with pytest.raises(DuplicateSourceKeyError):
            upsert(batch, table, ["k", "p"], null_safe_keys=null_safe)
        return
    upsert(batch, table, ["k", "p"], null_safe_keys=null_safe)
    got = read_table(spark, table).select("k", "p", "v").collect()
    assert sorted((tuple(row) for row in got), key=str) == want
