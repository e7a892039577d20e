import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plans import hash_exchanges, operators, plan_of

from tripmill.errors import MissingKeysError, MissingOrderError
from tripmill.operators import dedup_by_key

SCHEMA = "k int, name string, a double, b int"


def kept(spark, rows, keys=("k",), order_by=("a",), **options):
    out = dedup_by_key(spark.createDataFrame(rows, SCHEMA), list(keys), list(order_by), **options)
    assert out.columns == ["k", "name", "a", "b"]
    return sorted((tuple(row) for row in out.collect()), key=str)


def test_last_row_per_key(spark):
    rows = [(1, "x", 1.0, 0), (1, "y", 3.0, 0), (1, "z", 2.0, 0), (2, "x", 0.0, 0)]
    assert kept(spark, rows) == [(1, "y", 3.0, 0), (2, "x", 0.0, 0)]


def test_first_row_per_key(spark):
    rows = [(1, "x", 1.0, 0), (1, "y", 3.0, 0), (2, "x", 0.0, 0)]
    assert kept(spark, rows, ascending=True) == [(1, "x", 1.0, 0), (2, "x", 0.0, 0)]


def test_null_comes_last_descending_and_first_ascending(spark):
    rows = [(1, "x", None, 0), (1, "y", 3.0, 0)]
    assert kept(spark, rows) == [(1, "y", 3.0, 0)]
    assert kept(spark, rows, ascending=True) == [(1, "x", None, 0)]


def test_null_keys_are_one_key(spark):
    rows = [(None, "x", 1.0, 0), (None, "y", 2.0, 0)]
    assert kept(spark, rows) == [(None, "y", 2.0, 0)]


def test_ties_do_not_depend_on_how_rows_lie(spark):
    rows = [(1, "x", 1.0, n) for n in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    for parts in (1, 3, 16):
        out = dedup_by_key(df.repartition(parts, "b"), ["k"], ["a"]).collect()
        assert [tuple(row) for row in out] == [(1, "x", 1.0, 39)]


def test_order_by_a_key_column_only(spark):
    rows = [(1, "x", 1.0, 0), (1, "x", 2.0, 5), (1, "x", 2.0, 4)]
    assert kept(spark, rows, keys=("k", "name"), order_by=("k",)) == [(1, "x", 2.0, 5)]


def test_all_columns_as_key(spark):
    rows = [(1, "x", 1.0, 0)] * 3
    assert kept(spark, rows, keys=("k", "name", "a", "b"), order_by=("k",)) == [(1, "x", 1.0, 0)]


def test_names_in_any_case(spark):
    rows = [(1, "x", 1.0, 0), (1, "y", 3.0, 0)]
    assert kept(spark, rows, keys=("K",), order_by=("A",)) == [(1, "y", 3.0, 0)]


def test_arguments(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(MissingKeysError):
        dedup_by_key(df, [], ["a"])
    with pytest.raises(MissingOrderError):
        dedup_by_key(df, ["k"], [])
    with pytest.raises(TypeError):
        dedup_by_key(df, ["k"], ["a"], ascending="false")


def test_rows_are_combined_before_the_only_shuffle(spark):
    df = spark.createDataFrame([(1, "x", 1.0, 0)], SCHEMA)
    out = dedup_by_key(df, ["k", "name"], ["a"])
    names = [name for name in operators(out) if "Aggregate" in name or name == "Exchange"]
    assert names == ["SortAggregate", "Exchange", "SortAggregate"]
    assert hash_exchanges(out) == 1


def test_sorts_by_one_hash_of_several_keys_first(spark):
    rows = [(1, "x", 1.0, 0), (1, "x", 2.0, 0), (None, "x", 1.0, 0), (None, "x", 0.0, 1), (1, None, 5.0, 0)]
    out = dedup_by_key(spark.createDataFrame(rows, SCHEMA), ["k", "name"], ["a"])
    sorts = [line for line in plan_of(out).splitlines() if "Sort [" in line]
    assert sorts and all("Sort [_groupingexpression" in line for line in sorts)
    assert sorted((tuple(row) for row in out.collect()), key=str) == [(1, "x", 2.0, 0), (1, None, 5.0, 0), (None, "x", 1.0, 0)]


def test_text_equal_by_its_collation_is_one_key(spark):
    df = spark.sql("SELECT 1 AS k, 2 AS n, x COLLATE utf8_lcase AS name, a FROM VALUES ('a', 1.0D), ('A', 2.0D), ('b', 0.0D) AS t(x, a)")
    out = dedup_by_key(df, ["k", "n", "name"], ["a"])
    assert sorted(row["a"] for row in out.collect()) == [0.0, 2.0]


values = st.one_of(st.none(), st.floats(-3, 3, width=16), st.just(math.nan))
rows_of_trips = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.sampled_from("xy"), values, st.integers(0, 3)),
    max_size=25,
)


@settings(max_examples=15, deadline=None)
@given(rows=rows_of_trips, ascending=st.booleans())
def test_one_row_per_key_and_it_is_the_extreme_one(spark, rows, ascending):
    def rank(row):
        _, name, a, b = row
        number = -math.inf if a is None else math.inf if math.isnan(a) else a + 0.0
        return (number, a is not None, name, b)

    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    extreme = min if ascending else max
    want = sorted((str(rank(extreme(group, key=rank))) + str(k) for k, group in groups.items()))
    got = kept(spark, rows, ascending=ascending)
    assert sorted(str(rank(row)) + str(row[0]) for row in got) == want
