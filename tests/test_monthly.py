import gzip
import os
from pathlib import Path

import pytest
from plans import hash_exchanges, operators

from tripmill.plans import conform_feeds, run_month, to_trips, trip_table
from tripmill.plans.monthly import TRIP_SCHEMA
from tripmill.queries import _conformed
from tripmill.sources import read_table
from tripmill.sources.sample_feeds import sample_feed

HEADER = (
    "VendorID,{p}_pickup_datetime,{p}_dropoff_datetime,passenger_count,trip_distance,RatecodeID,PULocationID,"
    "DOLocationID,payment_type,total_amount"
)
GREEN = [
    "2,2019-12-01 00:05:00,2019-12-01 00:15:00,1,1.5,1,7,8,2,9.75",
    "2,2019-12-01 00:05:00,2019-12-01 00:15:00,1,1.5,1,7,8,2,9.75",  # the same line again
    "2,2019-12-01 00:05:00,2019-12-01 00:15:00,1,1.7,1,7,8,2,9.75",  # the same trip, longer
    "1,2019-12-02 10:00:00,2019-12-02 10:01:29,2,0.4,6,7,,,5.0",
    "1,2019-12-02 10:00:00,2019-12-02 10:01:29,0,0.4,6,7,8,1,5.0",  # nobody on board
]
YELLOW = [
    "2,2019-12-01 00:05:00,2019-12-01 00:15:00,1,1.5,1,7,8,2,9.75",
    "1,2008-12-31 23:59:00,2009-01-01 00:09:00,1,3.0,,9,9,1,12.5",  # a stray year
]


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"

    def deliver(month, green, yellow):
        for service, prefix, lines in (("green", "lpep", green), ("yellow", "tpep", yellow)):
            folder = root / service
            folder.mkdir(parents=True, exist_ok=True)
            text = "\n".join([HEADER.format(p=prefix), *lines]) + "\n"
            (folder / f"{service}_tripdata_{month}.csv.gz").write_bytes(gzip.compress(text.encode()))
        return str(root)

    return deliver


@pytest.mark.parametrize("inferred", [False, True])
def test_two_months_and_a_correction(spark, landing, folder, schema_name, inferred):
    table = trip_table(f"{schema_name}.trips", folder)
    options = {"types": None} if inferred else {}
    root = landing("2019-12", GREEN, YELLOW)
    first = run_month(spark, root, "2019-12", table, null_safe_keys=True, **options)
    assert (first.source_rows, first.inserted) == (4, 4)

    trips = spark.table(table.name)
    assert set(trips.columns) == {"TaxiDataId", *TRIP_SCHEMA.names}
    got = {(row["TripMode"], row["TripYear"], row["PassengerCount"]): row for row in trips.collect()}
    longest = got["Green", 2019, 1]
    assert (longest["TripDistance"], longest["TripTimeInMinutes"], longest["TripType"]) == (1.7, 10, "SoloTrip")
    shared = got["Green", 2019, 2]
    assert (shared["TripType"], shared["PaymentType"], shared["DropLocationId"]) == ("SharedTrip", 5, None)
    assert shared["TripTimeInMinutes"] == 1
    assert got["Yellow", 2008, 1]["TripMonth"] == 12

    again = run_month(spark, root, "2019-12", table, null_safe_keys=True, **options)
    assert (again.updated, again.inserted) == (0, 0)

    corrected = [line.replace(",9.75", ",10.25") for line in YELLOW[:1]]
    new = ["1,2020-01-05 08:00:00,2020-01-05 08:30:00,1,2.0,1,5,6,1,20.0"]
    landing("2020-01", new, corrected)
    second = run_month(spark, root, "2020-01", table, null_safe_keys=True, **options)
    assert (second.updated, second.inserted) == (1, 1)
    assert second.rewritten_partitions == (("2019", "12"),)
    final = spark.table(table.name).collect()
    numbers = sorted(row["TaxiDataId"] for row in final)
    assert numbers[:4] == [1, 2, 3, 4] and len(numbers) == 5 and numbers[4] > 4
    assert [row["TotalAmount"] for row in final if row["TripMode"] == "Yellow" and row["TripYear"] == 2019] == [10.25]


def test_no_row_is_lost_without_a_count(spark, landing, folder, schema_name):
    """Whole numbers written as decimals are read; what cannot be read is counted, whichever way types are found."""
    green = [
        "2,2019-12-01 00:05:00,2019-12-01 00:15:00,1.0,1.5,1,7,8,2,9.75",
        "2,2019-12-01 00:06:00,2019-12-01 00:15:00,2,1.5,1.0,7,8,2,9.75",
        "2,2019-12-01 00:07:00,2019-12-01 00:15:00,x,1.5,1,7,8,2,9.75",
        "2,2019-12-01 00:08:00,2019-12-01 00:15:00,1,1.5,?,7,8,,9.75",
    ]
    root = landing("2019-12", green, YELLOW[:1])
    reports = []
    for i, options in enumerate(({}, {"types": None})):
        table = trip_table(f"{schema_name}.trips_{i}", f"{folder}_{i}")
        reports.append(run_month(spark, root, "2019-12", table, **options))
    assert reports[0] == reports[1]
    assert (reports[0].inserted, reports[0].unreadable) == (4, 2)


def test_all_months_by_glob(spark, landing, folder, schema_name):
    landing("2019-11", GREEN[:1], [])
    root = landing("2019-12", [], YELLOW)
    table = trip_table(f"{schema_name}.trips", folder)
    assert run_month(spark, root, "*", table).inserted == 3
    assert read_table(spark, table).count() == 3


def test_a_landed_month_is_not_read_from_gzip_again(spark, landing, folder, tmp_path, schema_name):
    root, landed = landing("2019-12", GREEN, YELLOW), str(tmp_path / "landed")
    reports = []
    for i in range(3):
        if i == 1:
            # Broken in place, with size and time kept: whoever opened the file would notice.
            for file in Path(root).rglob("*.gz"):
                stat = file.stat()
                file.write_bytes(b"x" * stat.st_size)
                os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))
        if i == 2:
            landing("2019-12", GREEN + ["1,2019-12-03 10:00:00,2019-12-03 10:01:29,2,0.4,6,7,,,5.0"], YELLOW)
        table = trip_table(f"{schema_name}.trips_{i}", f"{folder}_{i}")
        reports.append(run_month(spark, root, "2019-12", table, landed=landed))
    assert reports[0] == reports[1] and reports[0].inserted == 4
    assert reports[2].inserted == 5


def test_a_landing_that_died_is_done_again(spark, landing, folder, tmp_path, schema_name):
    root, landed = landing("2019-12", GREEN, YELLOW), str(tmp_path / "landed")
    (tmp_path / "landed" / "green" / "2019-12" / "rows").mkdir(parents=True)
    table = trip_table(f"{schema_name}.trips", folder)
    assert run_month(spark, root, "2019-12", table, landed=landed).inserted == 4


def test_bad_lines_are_set_aside_and_counted(spark, landing, folder, tmp_path, schema_name):
    bad = ["2,2019-12-01 00:07:00,2019-12-01 00:15:00,x,1.5,1,7,8,2,9.75", "2,2019-12-01"]
    root, aside = landing("2019-12", GREEN + bad, YELLOW), str(tmp_path / "aside")
    table = trip_table(f"{schema_name}.trips", folder)
    for _ in range(2):
        report = run_month(spark, root, "2019-12", table, null_safe_keys=True, quarantine=aside)
        assert (report.source_rows, report.unreadable, report.quarantined) == (4, 0, 2)
    lines = spark.read.parquet(f"{aside}/green/2019-12")
    assert {(row["line"], row["reason"]) for row in lines.collect()} == {(bad[0], "value of passenger_count"), (bad[1], "fields")}
    for wrong in ({"landed": "x", "quarantine": "y"}, {"quarantine": "y", "types": None}):
        with pytest.raises(ValueError):
            run_month(spark, root, "2019-12", table, **wrong)


def test_rows_left_after_the_known_steps(spark, tables):
    """Counts known for the smallest tables, with and without the rule on the drop location."""
    conformed = _conformed(spark, tables)
    assert conformed.count() == 6000
    assert to_trips(conformed).count() == 4764
    assert to_trips(conformed, ["PickupLocationId", "DropLocationId"]).count() == 4659


def test_one_shuffle_and_rows_combined_before_it(spark, tables):
    out = to_trips(conform_feeds(sample_feed(spark, tables, "green"), sample_feed(spark, tables, "yellow")))
    assert hash_exchanges(out) == 1
    names = operators(out)
    assert names.count("SortAggregate") == 2
    assert not {"Window", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"} & set(names)
