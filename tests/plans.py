"""Read executed plans in tests."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(df: DataFrame) -> str:
    """The plan with all details of each operator, which the short form cuts off."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def operators(df: DataFrame) -> list[str]:
    """Names of the physical operators, top first."""
    names = []
    for line in plan_of(df).splitlines():
        match = re.match(r"[\s:+\-|*()\d]*([A-Z]\w+)", line)
        if match:
            names.append(match.group(1))
    return names


def hash_exchanges(df: DataFrame) -> int:
    return plan_of(df).count("Exchange hashpartitioning")
