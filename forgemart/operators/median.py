"""Exact median per group without gathering a group's values in one place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Width of a coarse bucket in hours (2^15 seconds). A century of second-precision durations has about 96,000
# buckets of at most 32,768 distinct values, so neither step below ever sorts more rows than that per group.
BUCKET_HOURS = 32768 / 3600.0


def grouped_median(df: DataFrame, keys: Sequence[str], hours: str, name: str) -> DataFrame:
    """``keys`` and the interpolated median of ``hours``; null values, null keys and empty groups are left out.

    Values are counted per (key, value) before the first shuffle. Bucket totals locate the bucket or two that
    hold the middle ranks, and only the counted values of those buckets are ranked. All conditions the join
    would add are stated up front: both its sides then read the same shuffle, so the input is scanned once.
    """
    keys = list(keys)
    bucket = F.floor(F.col(hours) / F.lit(BUCKET_HOURS))
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, hours]], bucket.isNotNull())
    counted = (
        df.filter(known)
        .groupBy(*keys, F.col(hours).alias("_value"), bucket.alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return _median_of_counts(counted, keys, name)


def grouped_summary(
    df: DataFrame, keys: Sequence[str], hours: str, counts: Mapping[str, Column], mean: str, median: str
) -> DataFrame:
    """``keys``, the rows of each group for which the conditions in ``counts`` hold, and the mean and the interpolated
    median of ``hours``, from one scan. Null keys are groups of their own; without keys there is always one row.

    Counts and values go through one shuffle, which all branches read. Nothing in it may be null but the value: a join
    would add conditions that make the branches differ. So the keys travel as a struct, and values that are null have
    a bucket of their own.
    """
    keys = list(keys)
    bucket = F.coalesce(F.floor(F.col(hours) / F.lit(BUCKET_HOURS)), F.lit(_NO_BUCKET))
    grouped = [F.struct(*keys).alias("_key")] if keys else []
    counted = df.groupBy(*grouped, F.col(hours).alias("_value"), bucket.alias("_bucket")).agg(
        F.count(hours).alias("_n"), *[F.count_if(condition).alias(name) for name, condition in counts.items()]
    )
    zero = F.lit(0).cast("bigint")
    of_group = ["_key"] if keys else []
    totals = counted.groupBy(*of_group).agg(
        *[F.coalesce(F.sum(name), zero).alias(name) for name in counts],
        F.try_divide(F.sum(F.col("_value") * F.col("_n")), F.sum("_n")).alias(mean),
    )
    # A condition that names every count, though only one matters: a branch without some counts would not share the
    # shuffle.
    valued = reduce(lambda a, b: a & b, [F.col(name) >= 0 for name in counts], F.col("_n") > 0)
    medians = _median_of_counts(counted.filter(valued).select(*of_group, "_value", "_bucket", "_n"), of_group, median)
    if not keys:
        return totals.withColumn(median, medians.scalar())
    return totals.join(medians, "_key", "left").select("_key.*", *[c for c in totals.columns if c != "_key"], median)


_NO_BUCKET = -(2**62)


def _median_of_counts(counted: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``keys`` and the median of the values in ``counted``: keys, _value, _bucket and _n."""
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    middle = (
        counted.groupBy(*keys, "_bucket")
        .agg(F.sum("_n").alias("_size"))
        .select(
            *keys,
            "_bucket",
            "_size",
            (F.sum("_size").over(upto) - F.col("_size")).alias("_before"),
            F.sum("_size").over(group).alias("_total"),
        )
        .filter((F.col("_before") <= high) & (F.col("_before") + F.col("_size") > low))
        .drop("_size")
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy("_value")
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.join(middle, [*keys, "_bucket"]).withColumn(
        "_last", F.col("_before") + F.sum("_n").over(running)
    )

    def value_at(rank):
        return F.max(F.when((F.col("_last") - F.col("_n") <= rank) & (F.col("_last") > rank), F.col("_value")))

    picked = ranked.groupBy(*keys).agg(value_at(low).alias("_low"), value_at(high).alias("_high"))
    return picked.filter(F.col("_low").isNotNull()).select(
        *keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * 0.5).alias(name)
    )
