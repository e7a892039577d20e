import math

from plans import formatted_plan, hash_exchanges

from tripmill.operators import clean
from tripmill.plans.trips import RAW_DEFAULTS, RAW_FILTER, RAW_REQUIRED

SCHEMA = (
    "passenger_count int, trip_distance double, PUlocationID int, DOlocationID int, RatecodeID int, "
    "payment_type int"
)


def cleaned(spark, rows, **rules):
    return sorted((tuple(row) for row in clean(spark.createDataFrame(rows, SCHEMA), **rules).collect()), key=str)


DEFAULT_RULES = {"where": RAW_FILTER, "required": RAW_REQUIRED, "defaults": RAW_DEFAULTS}


def test_the_four_steps(spark):
    rows = [
        (1, 2.0, 7, 8, 2, 3),
        (0, 2.0, 7, 8, 2, 3),  # no passenger
        (None, 2.0, 7, 8, 2, 3),  # an unknown number is not more than 0
        (1, 0.0, 7, 8, 2, 3),  # no distance
        (1, 2.0, None, 8, 2, 3),
        (1, 2.0, 7, None, 2, 3),
        (2, 2.0, 7, 8, None, None),  # filled
        (2, 2.0, 7, 8, 1, 5),  # equal to the one before once it is filled
    ]
    assert cleaned(spark, rows, **DEFAULT_RULES) == [(1, 2.0, 7, 8, 2, 3), (2, 2.0, 7, 8, 1, 5)]


def test_required_names_may_repeat_and_leave_other_columns_alone(spark):
    rows = [(1, 2.0, 7, None, 2, 3), (1, 2.0, None, 8, 2, 3)]
    rules = DEFAULT_RULES | {"required": ["PULocationID", "PULocationID"]}
    assert cleaned(spark, rows, **rules) == [(1, 2.0, 7, None, 2, 3)]


def test_nan_counts_as_missing(spark):
    rows = [(1, math.nan, 7, 8, 2, 3), (1, None, 7, 8, 2, 3), (1, 1.0, 7, 8, 2, 3)]
    assert cleaned(spark, rows, required=["trip_distance"]) == [(1, 1.0, 7, 8, 2, 3)]


def test_same_rows_as_na_drop(spark):
    rows = [(1, math.nan, 7, 8, 2, 3), (1, 1.0, None, 8, 2, 3), (1, 1.0, 7, 8, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    subset = ["trip_distance", "pulocationid"]
    assert clean(df, required=subset).collect() == df.na.drop(subset=subset).collect()


def test_no_rules_leave_only_the_distinct(spark):
    rows = [(1, 2.0, 7, 8, 2, 3)] * 3
    assert len(cleaned(spark, rows)) == 1
    assert len(cleaned(spark, rows, distinct=False)) == 3


def test_rules_reach_the_scan(spark, folder):
    spark.createDataFrame([(1, 2.0, 7, 8, 2, 3)], SCHEMA).write.parquet(folder)
    out = clean(spark.read.parquet(folder), **DEFAULT_RULES, distinct=False)
    pushed = next(line for line in formatted_plan(out).splitlines() if line.startswith("PushedFilters")).lower()
    for condition in ("greaterthan(passenger_count,0)", "isnotnull(pulocationid)", "isnotnull(dolocationid)"):
        assert condition in pushed
    assert hash_exchanges(out) == 0
