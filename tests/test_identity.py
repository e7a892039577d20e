from hypothesis import given, settings
from hypothesis import strategies as st
from plans import operators
from pyspark.sql import functions as F

from tripmill.operators import assign_surrogate_key


def test_numbers_follow_the_order(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("v"))
    out = assign_surrogate_key(df, "sk", ["v"])
    assert out.columns == ["sk", "v"]
    assert out.dtypes[0] == ("sk", "bigint")
    assert all(row["sk"] == row["v"] + 1 for row in out.collect())


def test_without_order_there_is_no_shuffle_and_no_gap(spark):
    out = assign_surrogate_key(spark.range(0, 100, 1, 5), "sk", start=11)
    assert sorted(row["sk"] for row in out.collect()) == list(range(11, 111))
    assert "Window" not in operators(out) and "Exchange" not in operators(out)


def test_no_rows(spark):
    assert assign_surrogate_key(spark.range(0), "sk", ["id"]).count() == 0


def test_a_frequent_value_is_spread(spark):
    """Rows equal in all columns still go to several range partitions."""
    df = spark.range(0, 20_000, 1, 8).select(F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = assign_surrogate_key(df, "sk", ["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [row["count"] for row in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sorted(row["sk"] for row in out.collect()) == list(range(1, 20_001))
    assert max(sizes) < 20_000


@settings(max_examples=8, deadline=None)
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5)), max_size=40), start=st.integers(1, 10**12))
def test_numbers_are_dense_and_ordered(spark, values, start):
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    got = sorted(tuple(row) for row in assign_surrogate_key(df, "sk", ["v"], start).collect())
    assert [sk for sk, _ in got] == list(range(start, start + len(values)))
    in_order = sorted(values, key=lambda v: (v is not None, v or 0))
    assert [v for _, v in got] == in_order
