"""Compare a Spark result with the result of its oracle SQL, row by row and without regard to order."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame


def oracle_frame(tables: str, sql: str) -> pd.DataFrame:
    with duckdb.connect() as db:
        db.execute("SET TimeZone = 'UTC'")
        for file in Path(tables).glob("*.parquet"):
            db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        return db.execute(sql).df()


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[name]):
            frame[name] = frame[name].astype("datetime64[us]")
        elif pd.api.types.is_integer_dtype(frame[name]) or pd.api.types.is_float_dtype(frame[name]):
            frame[name] = frame[name].astype("float64")
        else:
            frame[name] = frame[name].astype(object).where(frame[name].notna(), None)
    return frame.sort_values(list(frame.columns), na_position="last", ignore_index=True)


def assert_same(result: DataFrame, expected: pd.DataFrame) -> None:
    got, want = normalised(result.toPandas()), normalised(expected)
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(got, want, check_exact=True, check_dtype=False)
