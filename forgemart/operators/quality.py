"""Checks of the star schema's constraints, and rule-based row validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgemart import schemas
from forgemart.operators.dedup import tie_break
from forgemart.operators.keys import unmatched


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values used more than once, with their row count; a null in the key exempts the row."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return df.filter(present).groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of nulls, in a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_nulls")


def orphans(fact: DataFrame, fact_column: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null reference points nowhere."""
    return unmatched(fact, fact_column, dim, key)


def not_in_set(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows with a non-null value outside ``allowed``."""
    return df.filter(~F.col(column).isin(list(allowed)))


def too_long(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with a text over its limit, and the names of the offending columns."""
    over = [F.when(F.char_length(F.col(c)) > n, F.lit(c)) for c, n in limits.items()]
    return df.withColumn("too_long", F.array_compact(F.array(*over))).filter(F.size("too_long") > 0)


def validate(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Split into rows that break no rule and rejected rows with the ``reasons`` they broke.

    A rule is a name and the condition that makes a row bad; a condition that is null does not reject.
    """
    marked = df.withColumn("reasons", F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules])))
    return marked.filter(F.size("reasons") == 0).drop("reasons"), marked.filter(F.size("reasons") > 0)


def reject_counts(rejected: DataFrame) -> DataFrame:
    """Rejected rows per reason."""
    return rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def constraints(table: str) -> list[tuple[str, Column]]:
    """The row rules of a gold table, from its contract: required columns, lengths of texts, allowed values."""
    rules = [(f"{c} is null", F.col(c).isNull()) for c in schemas.NOT_NULL.get(table, [])]
    rules += [
        (f"{c} has over {n} characters", F.char_length(F.col(c)) > n)
        for c, n in schemas.MAX_LENGTH.get(table, {}).items()
    ]
    rules += [
        (f"{c} is not one of {', '.join(values)}", ~F.col(c).isin(*values))
        for c, values in schemas.ALLOWED.get(table, {}).items()
    ]
    return rules


def tagged(
    df: DataFrame, rules: Sequence[tuple[str, Column]], unique: Sequence[Sequence[str]] = (), order: Sequence[Column] = ()
) -> DataFrame:
    """All rows with the ``reasons`` for which they are rejected, an empty array for none.

    Of rows that share a ``unique`` key the first stays: one that breaks no other rule, then by ``order``, then by
    all columns. A null in a key exempts the row; exempt rows are spread over the tasks.
    """
    marked = df.withColumn("reasons", F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules])))
    for key in unique:
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
        spread = F.when(~present, F.xxhash64(*[c for c in df.columns if c not in key]))
        ranking = [F.size("reasons"), *order, *tie_break(df)]
        place = F.row_number().over(Window.partitionBy(*key, spread).orderBy(*ranking))
        again = F.when(present & (F.col("_place") > 1), F.array(F.lit(f"{', '.join(key)} occurs twice")))
        marked = marked.withColumn("_place", place).withColumn(
            "reasons", F.concat("reasons", F.coalesce(again, F.array().cast("array<string>")))
        ).drop("_place")
    return marked
