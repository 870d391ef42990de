"""Upserts and incremental selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemart.operators.dedup import latest_by_key


def by_key(rows: DataFrame, other: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Semi- or anti-join on a key; nulls count as equal, as they do when a key is deduplicated."""
    side = other.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(key)])
    same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(key)]
    return rows.join(side, reduce(lambda a, b: a & b, same), how)


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Overwrite-by-key merge: incoming rows replace stored rows with the same key, the rest stay.

    Written as an anti-join plus union, so a small delta is broadcast (when Spark measures it as small) and
    the stored table is not shuffled at all.
    """
    latest = latest_by_key(new, key, order)
    return by_key(old, latest, key, "left_anti").unionByName(latest)


def touched_partitions(old: DataFrame, new: DataFrame, key: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Stored rows of every partition the delta changes.

    That is the partitions the incoming rows fall into and those that hold an older copy of one of them.
    Partition values are never null.
    """
    hit = by_key(old, new, key, "left_semi").select(*parts)
    changed = new.select(*parts).unionByName(hit).distinct()
    return old.join(changed, list(parts), "left_semi")


def high_water_mark(silver: DataFrame, key: str, ts: str) -> DataFrame:
    """Latest time loaded so far per key."""
    return silver.groupBy(key).agg(F.max(ts).alias("mark"))


def incremental_filter(df: DataFrame, marks: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows at or after their key's mark, and all rows of keys that have none.

    The mark itself is included because rows sharing its timestamp may not have been loaded yet; the upsert
    absorbs the ones that have.
    """
    side = marks.select(F.col(key).alias("_key"), "mark")
    joined = df.join(side, F.col(key) == F.col("_key"), "left")
    return joined.filter(F.col("mark").isNull() | (F.col(ts) >= F.col("mark"))).drop("_key", "mark")
