"""Surrogate keys without a database sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY_BUCKETS = 4096


def row_handle(*natural: str) -> Column:
    """Row identifier of a fact, a function of its natural key alone.

    No query joins or counts distinct on it, so loading a fact needs no shuffle to number its rows.
    """
    return F.xxhash64(*natural)


def numbered(df: DataFrame, natural: str, name: str, after: Column | None = None) -> DataFrame:
    """Add a unique positive BIGINT key; ``natural`` must be unique and non-null.

    Rows are numbered inside hash buckets of the natural key and the bucket number is folded in, so the keys
    cannot collide, depend only on the set of natural keys, and need no global sort.
    """
    bucket = F.pmod(F.xxhash64(natural), F.lit(KEY_BUCKETS))
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural))
    key = (position.cast("bigint") - 1) * KEY_BUCKETS + F.col("_bucket") + 1
    if after is not None:
        key = key + after
    return df.withColumn("_bucket", bucket).withColumn(name, key).drop("_bucket")


def with_kept_keys(existing: DataFrame, incoming: DataFrame, natural: str, name: str) -> DataFrame:
    """Incoming rows keyed so that known natural keys keep theirs and new ones follow the highest used."""
    known = existing.select(natural, name)
    kept = incoming.join(known, natural)
    highest = existing.select(F.coalesce(F.max(name), F.lit(0).cast("bigint")).alias("top")).scalar()
    fresh = numbered(incoming.join(known, natural, "left_anti"), natural, name, after=highest)
    return kept.unionByName(fresh)


def lookup(fact: DataFrame, dim: DataFrame, natural: str, fact_column: str, key: str, name: str) -> DataFrame:
    """Left-join one key column of a dimension; null and unknown natural keys give null.

    The dimension side is two columns wide. Spark broadcasts it only when its size estimate or the size
    measured at run time is below the session's limit, and otherwise sorts and merges, splitting hot keys.
    """
    side = dim.select(F.col(natural).alias("_natural"), F.col(key).alias(name))
    return fact.join(side, fact[fact_column] == F.col("_natural"), "left").drop("_natural")


def unmatched(fact: DataFrame, fact_column: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact`` whose non-null reference has no row in ``dim``."""
    side = dim.select(F.col(key).alias("_key"))
    return fact.filter(F.col(fact_column).isNotNull()).join(side, F.col(fact_column) == F.col("_key"), "left_anti")


def touched_dates(fact: DataFrame, columns: Sequence[str], name: str = "date_id") -> DataFrame:
    """One row per fact row and distinct non-null date among ``columns``.

    Turns ``date IN (a, b, c)`` into an equality join.
    """
    dates = F.array_distinct(F.array_compact(F.array(*[F.col(c) for c in columns])))
    return fact.withColumn(name, F.explode(dates))
