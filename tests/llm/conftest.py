from __future__ import annotations

import pytest
from pyspark.sql import DataFrame


@pytest.fixture(scope="session")
def small() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with columns that an operator must not mind."""

    def make(rows) -> DataFrame:
        schema = "doc_id long, text string, score int, node string, row_id int, run long, digest string, w int, key int"
        return spark.createDataFrame([(i, text, 1, "n", 2, 3, "d", 4, 5) for i, text in rows], schema)

    return make


# NULL and empty texts, NULL ids, repeated rows, ties, and one very long text.
ODD = [
    (1, None),
    (2, ""),
    (None, "one two three"),
    (None, None),
    (3, "same text here"),
    (3, "same text here"),
    (4, "same text here"),
    (5, " \n\t !!! "),
    (6, "word " * 40_000),
    (7, "ünïcödé 日本語 😀".encode("utf-16", "surrogatepass").decode("utf-16")),
]


@pytest.fixture
def odd(docs) -> DataFrame:
    return docs(ODD)


@pytest.fixture
def nothing(docs) -> DataFrame:
    return docs([])
