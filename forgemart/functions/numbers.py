"""Numeric expressions shared by the analytic queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_place(value: Column) -> Column:
    """Decimal rounding to one place, half away from zero, given back as a double."""
    return F.round(value.cast("decimal(38,6)"), 1).cast("double")


def percent_of(part: Column, total: Column) -> Column:
    """``part`` as a percentage of ``total`` with one decimal; null when the total is zero."""
    return F.when(total > 0, one_place(part * 100.0 / total))


def long_sum(value: Column) -> Column:
    """Sum as BIGINT, 0 when there is nothing to add."""
    return F.coalesce(F.sum(value.cast("bigint")), F.lit(0).cast("bigint"))


def map_total(sizes: Column) -> Column:
    """Sum of a map's values; 0 for an empty or missing map."""
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.aggregate(F.map_values(sizes), zero, lambda acc, x: acc + F.coalesce(x, zero)), zero)
