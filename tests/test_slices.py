"""Slices of partitions, and the switch of partitions in the catalog."""

import datetime as dt
import shutil
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripmill.errors import MergeError, PartitionColumnError
from tripmill.operators import merge, upsert
from tripmill.scratch import new_folder
from tripmill.sources import Slices, Table, ensure_table, read_table, write_table

SCHEMA = "k int, y int, v string"


def catalog_table(spark, folder, schema_name, schema=SCHEMA, partition_by=("y",), **options):
    table = Table(folder, partition_by, name=f"{schema_name}.t", **options)
    return ensure_table(spark, spark.createDataFrame([], schema).schema, table)


def rows(spark, table):
    return sorted((tuple(row) for row in read_table(spark, table).collect()), key=str)


def bytes_below(*folders):
    return sum(f.stat().st_size for folder in folders if Path(folder).exists() for f in Path(folder).rglob("*.parquet"))


def beside(table):
    path = Path(table.path)
    return sorted(p.name.removeprefix(path.name) for p in path.parent.iterdir() if p.name.startswith(path.name + "_"))


# ---- switch


def test_a_changed_partition_is_written_once(spark, folder, schema_name, monkeypatch):
    """What an update writes is the changed partition, one time; by path, it is written two times."""
    wide = spark.range(20_000).select(
        F.col("id").cast("int").alias("k"), (F.col("id") % 4).cast("int").alias("y"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    batch = wide.filter("k = 5").withColumn("v", F.lit("new"))
    written = {}
    for kind in ("catalog", "path"):
        place = f"{folder}-{kind}"
        table = catalog_table(spark, place, schema_name) if kind == "catalog" else Table(place, ("y",))
        write_table(wide, table)
        partition = bytes_below(f"{place}/y=1")
        # Nothing is deleted, so all that was ever written can be counted.
        with monkeypatch.context() as patch:
            patch.setattr(merge, "drop_folder", lambda *_: None)
            old = {f for f in Path(place).rglob("*.parquet")}
            assert upsert(batch, table, ["k", "y"]).rewritten_partitions == (("1",),)
        new = [f for root in (place, f"{place}_pending/rows", f"{place}_versions") for f in Path(root).rglob("*.parquet") if f not in old]
        written[kind] = sum(f.stat().st_size for f in new) / partition
        assert read_table(spark, table).filter("v = 'new'").count() == 1 and read_table(spark, table).count() == 20_000
    assert written["catalog"] < 0.6 * written["path"] and 0.9 < written["catalog"] < 1.1


def test_old_folders_go_and_new_rows_find_their_partition(spark, folder, schema_name):
    table = catalog_table(spark, folder, schema_name)
    write_table(spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, None, "d")], SCHEMA), table)
    for turn in range(3):
        batch = spark.createDataFrame([(1, 1, f"a{turn}"), (10 + turn, 1, "new"), (4, None, f"d{turn}"), (20 + turn, 7, "x")], SCHEMA)
        report = upsert(batch, table, ["k", "y"], null_safe_keys=True)
        assert (report.updated, report.inserted) == (2, 2)
        assert report.rewritten_partitions == (("1",), (None,))
    want = {(1, "a2"), (2, "b"), (3, "c"), (4, "d2"), *((10 + t, "new") for t in range(3)), *((20 + t, "x") for t in range(3))}
    assert {row[:2] for row in rows(spark, table)} == want
    assert not (Path(folder) / "y=1").exists() and (Path(folder) / "y=2").exists()
    live = {Path(f.removeprefix("file:").replace("///", "/")).parents[1].name for f in spark.table(table.name).inputFiles() if "_versions" in f}
    folders = [p for p in Path(f"{folder}_versions").iterdir() if any(p.rglob("*.parquet"))]
    assert {p.name for p in folders} == live and len(live) == 1
    assert "_pending" not in beside(table)


def test_partition_values_with_special_characters(spark, folder, schema_name):
    values = ["a b", "c%d", "e/f", "g=h", "ü'\"", "x:y", "%20", None]
    schema = "k int, v string, p string"
    table = catalog_table(spark, folder, schema_name, schema, ("p",))
    write_table(spark.createDataFrame([(i, "old", p) for i, p in enumerate(values)], schema), table)
    for turn in range(2):
        batch = spark.createDataFrame([(i, f"new{turn}", p) for i, p in enumerate(values)], schema)
        assert upsert(batch, table, ["k", "p"], null_safe_keys=True).updated == len(values)
    assert {(row["k"], row["v"], row["p"]) for row in read_table(spark, table).collect()} == {(i, "new1", p) for i, p in enumerate(values)}
    assert bytes_below(folder) == 0


@pytest.mark.parametrize("done", [0, 1, 2])
def test_a_death_during_the_switch_loses_nothing(spark, folder, schema_name, monkeypatch, done):
    table = catalog_table(spark, folder, schema_name)
    write_table(spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, 3, "d")], SCHEMA), table)
    batch = spark.createDataFrame([(1, 1, "A"), (3, 2, "C"), (9, 3, "new")], SCHEMA)
    whole = merge.point_partitions

    def dies(spark, table, places):
        whole(spark, table, places[:done])
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(merge, "point_partitions", dies)
        with pytest.raises(MergeError, match="next upsert goes on"):
            upsert(batch, table, ["k", "y"])
    report = upsert(batch, table, ["k", "y"])
    assert (report.updated, report.inserted) == (0, 1)
    assert {row[:2] for row in rows(spark, table)} == {(1, "A"), (2, "b"), (3, "C"), (4, "d"), (9, "new")}
    assert "_pending" not in beside(table)


@pytest.mark.parametrize("named", [False, True])
def test_a_note_that_was_not_finished_is_cleared(spark, folder, schema_name, named):
    table = catalog_table(spark, folder, schema_name) if named else Table(folder, ("y",))
    write_table(spark.createDataFrame([(1, 1, "a")], SCHEMA), table)
    Path(f"{folder}_pending/complete/_temporary/0").mkdir(parents=True)
    assert not merge.recover(spark, table)
    assert not Path(f"{folder}_pending").exists()
    assert upsert(spark.createDataFrame([(1, 1, "A")], SCHEMA), table, ["k", "y"]).updated == 1


def test_a_switch_that_is_done_again_keeps_the_new_rows(spark, folder, schema_name, monkeypatch):
    """The job died after the switch, with its note still there."""
    table = catalog_table(spark, folder, schema_name)
    write_table(spark.createDataFrame([(1, 1, "a")], SCHEMA), table)
    with monkeypatch.context() as patch:
        patch.setattr(merge, "drop_folder", lambda *_: None)
        upsert(spark.createDataFrame([(1, 1, "A")], SCHEMA), table, ["k", "y"])
    assert merge.recover(spark, table)
    assert rows(spark, table) == [(1, "A", 1)]
    assert not (Path(folder) / "y=1").exists()


def test_files_of_a_switched_partition_stay_sorted(spark, folder, schema_name):
    schema = "k int, t timestamp, v int, y int"
    table = catalog_table(spark, folder, schema_name, schema, ("y",), cluster_by=("t",))
    data = [(n, dt.datetime(2001, 1, 1) + dt.timedelta(minutes=n * 37 % 5000), 0, 1) for n in range(5000)]
    write_table(spark.createDataFrame(data, schema), table)
    upsert(spark.createDataFrame([(*data[7][:2], 1, 1)], schema), table, ["k", "t", "y"])
    upsert(spark.createDataFrame([(-1, dt.datetime(2001, 1, 1), 1, 1)], schema), table, ["k", "t", "y"])
    spans = []
    for file in Path(f"{folder}_versions").rglob("*.parquet"):
        times = pq.read_table(file, columns=["t"]).column("t").to_pylist()
        assert times == sorted(times)
        spans.append((times[0], times[-1], len(times)))
    assert sum(count for *_, count in spans) == 5001


# ---- slices


def test_one_changed_row_rewrites_a_slice(spark, folder, schema_name):
    """Of a month of 1.3 million rows less than a tenth is written."""
    table = catalog_table(spark, folder, schema_name, "k bigint, y int, v string", slices=Slices(("k",), count=16))
    rows = spark.range(1_300_000).select("id", F.lit(1).alias("y"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    write_table(rows.toDF("k", "y", "v"), table)
    whole = bytes_below(folder)
    batch = spark.createDataFrame([(777, 1, "new")], "k bigint, y int, v string")
    report = upsert(batch, table, ["k", "y"])
    assert report.updated == 1 and len(report.rewritten_partitions) == 1
    assert 0 < bytes_below(f"{folder}_versions") < 0.1 * whole
    assert read_table(spark, table).columns == ["k", "v", "y"]
    assert read_table(spark, table).filter("v = 'new'").collect()[0]["k"] == 777
    assert read_table(spark, table).count() == 1_300_000


@pytest.mark.parametrize("data_type", ["timestamp", "timestamp_ntz", "date"])
def test_slices_of_time(spark, folder, schema_name, data_type):
    schema = f"k int, t {data_type}, v int, y int"
    table = catalog_table(spark, folder, schema_name, schema, slices=Slices(("t",), seconds=86_400), identity="sk")
    days = [dt.datetime(1969, 12, 28) + dt.timedelta(days=n % 10) for n in range(40)]
    made = spark.createDataFrame([(n, day, 0, 1) for n, day in enumerate(days)] + [(99, None, 0, 1)], "k int, t timestamp_ntz, v int, y int")
    made = made.withColumn("t", F.col("t").cast(data_type))
    assert upsert(made, table, ["k", "t", "y"], null_safe_keys=True).inserted == 41
    changed = made.filter("k IN (3, 13, 99)").withColumn("v", F.lit(5))
    report = upsert(changed, table, ["k", "t", "y"], null_safe_keys=True)
    assert report.updated == 3 and len(report.rewritten_partitions) == 2
    assert {row["k"] for row in read_table(spark, table).filter("v = 5").collect()} == {3, 13, 99}
    assert upsert(made, table, ["k", "t", "y"], null_safe_keys=True).inserted == 0


def test_slices_without_partitions_and_by_path(spark, folder):
    schema = spark.createDataFrame([], "k int, v string").schema
    for i, given in enumerate((None, schema)):
        table = Table(f"{folder}{i}", slices=Slices(("k",), count=4), schema=given)
        write_table(spark.createDataFrame([(n, "a") for n in range(100)] + [(None, "n")], schema), table)
        report = upsert(spark.createDataFrame([(5, "b"), (None, "m"), (200, "c")], schema), table, ["k"], null_safe_keys=True)
        assert (report.updated, report.inserted) == (2, 1)
        got = read_table(spark, table)
        assert got.columns == ["k", "v"]
        assert {row[0] for row in got.filter("v <> 'a'").collect()} == {5, None, 200} and got.count() == 102


def test_slices_follow_the_types_of_the_target(spark, folder):
    """A key that is an int in the source and a bigint in the table has one slice."""
    table = Table(folder, slices=Slices(("k",), count=8))
    write_table(spark.createDataFrame([(n, 0) for n in range(50)], "k bigint, v int"), table)
    assert upsert(spark.createDataFrame([(n, 1) for n in range(50)], "k int, v int"), table, ["k"]).updated == 50


def test_wrong_slices(spark, folder, schema_name):
    for wrong in ({"by": ()}, {"by": ("k",)}, {"by": ("k",), "count": 4, "seconds": 5}, {"by": ("k",), "count": 0}, {"by": ("a", "b"), "seconds": 5}):
        with pytest.raises(ValueError):
            Slices(**wrong)
    with pytest.raises(PartitionColumnError):
        catalog_table(spark, folder, schema_name, slices=Slices(("nothing",), count=2))
    table = catalog_table(spark, folder, schema_name, slices=Slices(("v",), count=2))
    batch = spark.createDataFrame([(1, 1, "a")], SCHEMA)
    with pytest.raises(PartitionColumnError, match="must be a key"):
        upsert(batch, table, ["k", "y"])
    with pytest.raises(PartitionColumnError, match="follows from"):
        upsert(batch.withColumn("row_slice", F.lit(1)), table, ["k", "y", "v"])
    with pytest.raises(PartitionColumnError, match="no time column"):
        write_table(batch, Table(new_folder(spark, "x"), slices=Slices(("k",), seconds=5)))
