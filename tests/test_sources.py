import gzip

import pytest
from plans import formatted_plan, plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from tripmill.plans.trips import RAW_COLUMNS
from tripmill.sources import read_delimited, read_feeds, read_or_quarantine
from tripmill.sources.delimited import QUARANTINE

HEADER = (
    "VendorID;passenger_count;trip_distance;lpep_pickup_datetime;lpep_dropoff_datetime;PULocationID;DOLocationID;"
    "RatecodeID;total_amount;payment_type;store_and_fwd_flag"
)
LINE = "2;1;1.5;2019-12-01 00:05:00;2019-12-01 00:15:00;7;8;1;9.75;2;N"


@pytest.fixture
def csv(tmp_path):
    def write(name, *lines):
        file = tmp_path / name
        data = ("\n".join(lines) + "\n").encode()
        file.write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
        return str(file)

    return write


def test_asked_columns_in_asked_spelling(spark, csv):
    df = read_delimited(spark, csv("trips.csv", HEADER, LINE), RAW_COLUMNS, separator=";")
    assert df.columns == RAW_COLUMNS
    types = dict(df.dtypes)
    assert (types["VendorID"], types["trip_distance"]) == ("int", "double")
    assert types["lpep_pickup_datetime"].startswith("timestamp")


def test_all_columns_by_default(spark, csv):
    assert read_delimited(spark, csv("trips.csv", HEADER, LINE), separator=";").columns == HEADER.split(";")


def test_given_types_go_by_name(spark, csv):
    path = csv("t.csv", "b,extra,A", "x,1,7", "y,2,bad")
    df = read_delimited(spark, path, ["a", "b"], {"a": T.IntegerType(), "b": T.StringType()})
    assert [tuple(row) for row in df.collect()] == [(7, "x"), (None, "y")]
    assert df.dtypes == [("a", "int"), ("b", "string")]


def test_given_types_read_only_asked_columns(spark, csv):
    df = read_delimited(spark, csv("t.csv", "a,b,c", "1,2,3"), ["b"], {"b": T.IntegerType()})
    assert "ReadSchema: struct<b:string>" in df._jdf.queryExecution().executedPlan().toString()


def test_files_of_other_column_orders(spark, csv, tmp_path):
    csv("t_1.csv", "a,b", "1,x", "2,y")
    csv("t_2.csv", "B,extra,A", "z,0,3", "w,0,bad")
    csv("t_3.csv.gz", "a,b", "4,v")
    csv("t_4.csv", "a,b")
    types = {"a": T.IntegerType()}
    df = read_delimited(spark, f"{tmp_path}/t_*.csv*", ["b", "a"], types)
    assert sorted(map(tuple, df.collect()), key=str) == sorted([("x", 1), ("y", 2), ("z", 3), ("w", None), ("v", 4)], key=str)
    assert plan_of(df).count("Scan csv") == plan_of(df).count("Scan csv [a") + plan_of(df).count("Scan csv [B") == 2
    with pytest.raises(AnalysisException):
        read_delimited(spark, f"{tmp_path}/t_*.csv*", ["extra"], types)
    with pytest.raises(Exception, match="header does not conform"):
        read_delimited(spark, f"{tmp_path}/t_[12].csv", ["a"]).collect()


def test_one_header_is_one_scan(spark, csv, tmp_path):
    for n in range(5):
        csv(f"t_{n}.csv", "a,b", f"{n},x")
    df = read_delimited(spark, f"{tmp_path}/t_*.csv", ["a"], {"a": T.IntegerType()})
    assert sorted(row["a"] for row in df.collect()) == [0, 1, 2, 3, 4]
    assert plan_of(df).count("Scan csv") == 1 and "ReadSchema: struct<a:string>" in formatted_plan(df)


def test_every_line_is_loaded_or_set_aside(spark, csv, tmp_path):
    lines = ["1,x,2020-01-01", "2,y", "3,z,2020-01-01,9", "bad,w,2020-01-01", "5,,", ",q,nonsense", '6,"a,b",2020-01-02', "1.0,o,2020-01-01"]
    csv("d_1.csv", "a,b,day", *lines)
    csv("d_2.csv.gz", "day,a,b", "2020-05-05,7,s", "2020-05-05,8")
    types = {"a": T.IntegerType(), "day": T.DateType()}
    good, bad = read_or_quarantine(spark, f"{tmp_path}/d_*", ["a", "b"], types)
    assert good.dtypes == [("a", "int"), ("b", "string")]
    got = [(1, "x"), (1, "o"), (5, None), (6, "a,b"), (7, "s")]
    assert sorted(map(tuple, good.collect()), key=str) == sorted(got, key=str)
    aside = {(row["file"].rsplit("/", 1)[1], row["line"], row["reason"]) for row in bad.collect()}
    assert aside == {
        ("d_1.csv", "2,y", "fields"),
        ("d_1.csv", "3,z,2020-01-01,9", "fields"),
        ("d_1.csv", "bad,w,2020-01-01", "value of a"),
        ("d_1.csv", ",q,nonsense", "value of day"),
        ("d_2.csv.gz", "2020-05-05,8", "fields"),
    }
    assert good.count() + bad.count() == len(lines) + 2


def test_nothing_to_set_aside(spark, csv):
    path = csv("n.csv", "a,b")
    good, bad = read_or_quarantine(spark, path, ["a"], {"a": T.IntegerType()})
    assert good.count() == bad.count() == 0 and bad.columns == list(QUARANTINE)


def test_gzip_and_glob(spark, csv, tmp_path):
    csv("trips_2019-11.csv.gz", HEADER, LINE)
    csv("trips_2019-12.csv.gz", HEADER, LINE, LINE)
    assert read_delimited(spark, f"{tmp_path}/trips_*.csv.gz", separator=";").count() == 3


def test_without_header(spark, csv):
    path = csv("t.csv", "1,x", "2,y")
    assert read_delimited(spark, path, header=False).columns == ["_c0", "_c1"]
    df = read_delimited(spark, path, ["_c0"], {"_c0": T.LongType()}, header=False)
    assert [row[0] for row in df.collect()] == [1, 2]


def test_feeds_are_read_alike(spark, csv):
    green, yellow = csv("green.csv", "a;b", "1;2"), csv("yellow.csv", "c;a", "3;4")
    one, two = read_feeds(spark, [(green, ["b"]), (yellow, ["c", "a"])], separator=";")
    assert (one.columns, two.columns) == (["b"], ["c", "a"])
    assert tuple(two.first()) == (3, 4)
