from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tripmill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def tables() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture
def folder(tmp_path) -> str:
    """A path that does not exist yet."""
    return str(tmp_path / "table")


@pytest.fixture
def schema_name(spark):
    """An empty catalog schema, gone with all its tables afterwards."""
    name = "tripmill_test"
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")
