"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def owner_of(full_name: Column) -> Column:
    return F.split(full_name, "/", 2)[0]


def repo_of(full_name: Column) -> Column:
    """Everything after the first slash; null when there is none."""
    return F.get(F.split(full_name, "/", 2), 1)


def file_stem(full_name: Column) -> Column:
    """Repository name as a file name."""
    return F.replace(full_name, F.lit("/"), F.lit("_"))


def comma_list(text: Column) -> Column:
    """Trimmed, non-empty items of a comma-separated text."""
    items = F.transform(F.split(text, ","), lambda item: F.trim(item))
    return F.filter(items, lambda item: item != "")


def thousands(number: Column) -> Column:
    """1234567 as '1,234,567'."""
    return F.format_number(number, 0)


def duration_text(seconds: Column) -> Column:
    """Seconds as '12.3s', '4.5m' or '6.7h'."""
    def one_place(value: Column) -> Column:
        return F.round(value.cast("decimal(38,6)"), 1).cast("decimal(30,1)").cast("string")

    return (
        F.when(seconds < 60, F.concat(one_place(seconds), F.lit("s")))
        .when(seconds < 3600, F.concat(one_place(seconds / 60.0), F.lit("m")))
        .otherwise(F.concat(one_place(seconds / 3600.0), F.lit("h")))
    )
