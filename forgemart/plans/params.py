"""Checks of query parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_of(name: str, value: str, allowed: Sequence[str]) -> str:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}, not {value!r}")
    return value


def between(name: str, value: int, low: int, high: int | None = None) -> int:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be at least {low}" + (f" and at most {high}" if high is not None else ""))
    return value


def where_equal(df: DataFrame, **wanted: object) -> DataFrame:
    """Equality filters on the parameters that are given; 0 counts as given."""
    for column, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(column) == F.lit(value))
    return df


def last_periods(df: DataFrame, limit: int, column: str = "date") -> DataFrame:
    """The latest ``limit`` periods in chronological order."""
    return df.orderBy(F.col(column).desc_nulls_first()).limit(limit).orderBy(column)
