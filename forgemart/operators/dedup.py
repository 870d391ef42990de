"""Keep one row, or the first n rows, per key.

``row_number() <= n`` is planned with a per-task limit in front of the shuffle, so a key with a third of all
rows ships at most n rows per task rather than every copy. For n above one that may still be too much for the
one task that ranks the key, so its rows are first ranked in salted slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICES = 256


def tie_break(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """All remaining columns as sort keys, so equal-ranked rows that differ still have one order."""
    keys = []
    for field in df.schema.fields:
        if field.name in skip:
            continue
        if isinstance(field.dataType, T.MapType):
            keys.append(F.array_sort(F.map_entries(field.name)))
        else:
            keys.append(F.col(field.name))
    return keys


def latest_by_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order`` and then by every other column."""
    return _first_rows(df, key, [*order, *tie_break(df, key)], 1)


def repeats_a_key(df: DataFrame, key: Sequence[str]) -> bool:
    """Whether rows may share a key: false means that none do. Only a hash of the key is grouped."""
    hashes = df.groupBy(F.xxhash64(*key).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    return not hashes.filter(F.col("_n") > 1).isEmpty()


def cap_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key by ``order`` and then by every other column."""
    if n < 1:
        raise ValueError("n must be at least 1")
    ranking = [*order, *tie_break(df, key)]
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    # A slice is a function of the row alone, so a task that runs again cuts the same slices.
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*plain), F.lit(SLICES)))
    return _first_rows(_first_rows(sliced, [*key, "_slice"], ranking, n).drop("_slice"), key, ranking, n)


def _first_rows(df: DataFrame, key: Sequence[str], ranking: Sequence[Column], n: int) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*ranking)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")
