"""Bronze records to cleaned silver tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgemart import schemas
from forgemart.functions import times
from forgemart.operators.dedup import latest_by_key

PARTITIONS = ["year", "month"]


def typed_select(df: DataFrame, schema: T.StructType, renames: Mapping[str, str]) -> DataFrame:
    """Project to ``schema``; text that does not parse becomes null."""
    def typed(field: T.StructField) -> Column:
        source = renames.get(field.name, field.name)
        is_text = isinstance(df.schema[source].dataType, T.StringType)
        if isinstance(field.dataType, T.TimestampType) and is_text:
            return times.parse_time(F.col(source)).alias(field.name)
        return F.col(source).try_cast(field.dataType).alias(field.name)

    return df.select(*[typed(field) for field in schema])


def require_time(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def with_duration(df: DataFrame, name: str, end: str, start: str = "created_at") -> DataFrame:
    return df.withColumn(name, times.hours_between(F.col(start), F.col(end)))


def fill_defaults(df: DataFrame, entity: str) -> DataFrame:
    fills = schemas.FILLS[entity]
    return df.fillna(fills) if fills else df


def with_year_month(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns({"year": F.year(column), "month": F.month(column)})


def clean(entity: str, bronze: DataFrame) -> DataFrame:
    """Type, drop undated rows, keep the latest copy per natural key, derive durations, fill and partition.

    Copies are ranked by landing day, then ``updated_at``, then all other columns, so the outcome does not
    depend on the order of the input. Undated rows go first: a copy without a date never displaces a good one.
    """
    landed = landing_day(bronze)
    typed = typed_select(
        bronze.withColumn("_landed", landed),
        T.StructType([*schemas.silver(entity), T.StructField("_landed", T.IntegerType())]),
        schemas.RENAMES.get(entity, {}),
    )
    moment = schemas.EVENT_TIME.get(entity)
    if moment:
        typed = require_time(typed, moment)
    order = [F.col("_landed").desc_nulls_last()]
    if "updated_at" in typed.columns:
        order.append(F.col("updated_at").desc_nulls_last())
    kept = latest_by_key(typed, schemas.KEYS[entity], order).drop("_landed")
    if entity in schemas.DURATIONS:
        kept = with_duration(kept, *schemas.DURATIONS[entity])
    kept = fill_defaults(kept, entity)
    return with_year_month(kept, moment) if moment else kept


def landing_day(bronze: DataFrame) -> Column:
    """The day a record landed as a number; null for records without one."""
    if {"year", "month", "day"} <= set(bronze.columns):
        y, m, d = (F.col(c).cast("int") for c in ("year", "month", "day"))
        return y * 10000 + m * 100 + d
    return F.lit(None).cast("int")


def empty(spark: SparkSession, entity: str) -> DataFrame:
    """A silver table without rows."""
    raw = spark.createDataFrame([], schemas.bronze(entity))
    return clean(entity, raw)


def partition_columns(entity: str) -> list[str]:
    return PARTITIONS if entity in schemas.EVENT_TIME else []
