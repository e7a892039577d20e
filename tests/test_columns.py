import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from tripmill.operators import add_constants, rename_columns, union_feeds


def test_rename_keeps_order_and_unlisted_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rename_columns(df, ["b"], ["x"]).columns == ["a", "x", "c"]


def test_rename_of_nothing_changes_nothing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_columns(df, [], []).columns == ["a", "b"]


def test_rename_can_swap_two_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_columns(df, ["a", "b"], ["b", "a"]).first().asDict() == {"b": 1, "a": 2}


def test_rename_regards_case_and_ignores_spare_items(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_columns(df, ["A", "b", "c"], ["x", "y"]).columns == ["a", "y"]


def test_constants_of_four_types(spark):
    df = spark.range(3)
    names = ["col1", "col2", "col3", "col4", "col5"]
    out = add_constants(df, names, ["abc", 999, "2040-01-01", True, 0.01])
    assert [tuple(row) for row in out.select(names).distinct().collect()] == [
        ("abc", 999, "2040-01-01", True, 0.01)
    ]
    assert out.columns == ["id", *names]


def test_constant_without_value_is_null(spark):
    out = add_constants(spark.range(1), ["a", "b"], [1])
    assert out.schema["b"].dataType == T.NullType()
    assert out.first()["b"] is None


def test_constant_must_not_hide_a_column(spark):
    with pytest.raises(ValueError, match="ID"):
        add_constants(spark.range(1), ["ID"], [1])


def test_union_matches_names_not_places(spark):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    two = spark.createDataFrame([("y", 2)], "B string, A int")
    out = union_feeds(one, two)
    assert out.columns == ["a", "b"]
    assert sorted(tuple(row) for row in out.collect()) == [(1, "x"), (2, "y")]


def test_union_by_position_takes_first_names_and_widens(spark):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    two = spark.createDataFrame([(2.5, "y")], "c double, d string")
    out = union_feeds(one, two, by_position=True)
    assert out.dtypes == [("a", "double"), ("b", "string")]
    assert sorted(tuple(row) for row in out.collect()) == [(1.0, "x"), (2.5, "y")]


def test_union_of_other_names_is_refused(spark):
    with pytest.raises(AnalysisException):
        union_feeds(spark.range(1), spark.range(1).toDF("other"))


@settings(max_examples=10, deadline=None)
@given(sizes=st.lists(st.integers(0, 30), min_size=1, max_size=4))
def test_union_keeps_every_row(spark, sizes):
    feeds = [spark.range(size) for size in sizes]
    assert union_feeds(*feeds).count() == sum(sizes)
