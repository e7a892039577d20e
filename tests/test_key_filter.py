import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plans import formatted_plan, plan_of
from pyspark.sql import functions as F
from test_merge import settings_of

from tripmill.operators import merge, upsert
from tripmill.operators.key_filter import KeyFilter
from tripmill.scratch import new_folder, stage
from tripmill.sources import Table, read_table, write_table

values = st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1))
numbers = st.one_of(st.none(), st.sampled_from([0.0, -0.0, math.nan, math.inf, 1.5]), st.floats(allow_nan=False))
some = st.lists(st.tuples(values, st.one_of(st.none(), st.text(max_size=5)), numbers), min_size=1, max_size=200)


@settings(max_examples=10, deadline=None)
@given(rows=some, others=some, guess=st.integers(0, 10_000))
def test_no_key_is_lost(spark, rows, others, guess):
    schema = "a int, b string, c double"
    kept, tested = spark.createDataFrame(rows, schema), spark.createDataFrame([*rows, *others], schema)
    inside = KeyFilter.of(kept, ["a", "b", "c"], guess).may_hold(["a", "b", "c"])
    assert tested.limit(len(rows)).filter(~inside | inside.isNull()).count() == 0


@pytest.mark.parametrize(("keys", "guess", "most"), [(1_000, 1_000, 0.03), (100_000, 100_000, 0.03), (100_000, 1_000, 1.0)])
def test_few_other_keys_pass(spark, keys, guess, most):
    rows = spark.range(keys).select(F.col("id").alias("k"), (F.col("id") % 7).alias("p"))
    others = spark.range(10_000_000, 10_100_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("p"))
    found = KeyFilter.of(rows, ["k", "p"], guess)
    assert found.words.first()["words"].__len__() == found.size
    assert rows.filter(found.may_hold(["k", "p"])).count() == keys
    assert others.filter(found.may_hold(["k", "p"])).count() <= most * 100_000


def test_the_filter_of_nothing_lets_nothing_pass(spark):
    rows = spark.range(100).toDF("k")
    assert rows.filter(KeyFilter.of(rows.limit(0), ["k"], 0).may_hold(["k"])).count() == 0


def test_target_rows_are_dropped_before_the_shuffle(spark, folder, monkeypatch):
    table = Table(folder)
    write_table(spark.range(200_000).select((F.col("id") * 5).alias("k"), F.lit(0).alias("v")), table)
    batch = spark.range(2_000).select((F.col("id") * 500).alias("k"), F.lit(1).alias("v"))
    with settings_of(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        shuffled = {}
        for kind in ("all", "filtered"):
            plan = merge._resolve(batch, table, ["k"], None, None, False, False)
            touched = stage(merge._touched(plan, batch), new_folder(spark, "touched"))
            count, ranges = merge._ranges(plan, touched)
            nearby = merge._nearby(plan, touched, ranges)
            if kind == "filtered":
                nearby = nearby.filter(KeyFilter.of(batch, ["k"], count).may_hold(["k"]))
            found = merge._look_up(plan, nearby, batch.withColumn("_sid", F.monotonically_increasing_id()), plan.changes)
            assert len(found.collect()) == 2_000
            assert "SortMergeJoin" in plan_of(found) or "ShuffledHashJoin" in plan_of(found)
            shuffled[kind] = nearby.count()
        assert "Subquery" in formatted_plan(found) and "Python" not in formatted_plan(found)
        assert shuffled["all"] > 199_000 and shuffled["filtered"] < 2_000 + 0.03 * 200_000
        monkeypatch.setattr(merge, "_FILTER_FROM_ROWS", 1)
        assert upsert(batch, table, ["k"]).updated == 2_000
    assert read_table(spark, table).filter("v = 1").count() == 2_000


@pytest.mark.parametrize("null_safe", [False, True])
def test_filtered_upsert_with_null_keys_and_other_types(spark, folder, monkeypatch, null_safe):
    monkeypatch.setattr(merge, "_FILTER_FROM_ROWS", 1)
    table = Table(folder, ("p",))
    write_table(spark.createDataFrame([(1, "a", 0, 1), (None, "a", 0, 1), (2, None, 0, 2)], "k bigint, s string, v int, p int"), table)
    batch = spark.createDataFrame([(1, "a", 5, 1), (None, "a", 5, 1), (2, None, 5, 2), (3, "x", 5, 3)], "k int, s string, v int, p int")
    report = upsert(batch, table, ["k", "s", "p"], null_safe_keys=null_safe)
    assert (report.updated, report.inserted) == ((3, 1) if null_safe else (1, 3))


def test_the_keys_of_a_row_are_hashed_for_the_word_and_once_for_all_bits(spark):
    rows = spark.range(100).select(*(F.col("id").alias(name) for name in "abc"))
    tested = rows.filter(KeyFilter.of(rows, ["a", "b", "c"], 100).may_hold(["a", "b", "c"]))
    condition = next(line for line in plan_of(tested).splitlines() if "Filter" in line)
    assert condition.count("xxhash64(") == 2
    assert tested.count() == 100
