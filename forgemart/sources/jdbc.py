"""Relational tables over JDBC: partitioned reads and appends."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

Bounds = tuple[str, int, int, int]


def read_options(
    url: str, table: str, props: Mapping[str, str], split: Bounds | None = None, fetch_size: int = 10_000
) -> dict[str, str]:
    """Reader options; ``split`` is (column, lower, upper, partitions) and spreads the read over tasks."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **props}
    if split is not None:
        column, lower, upper, partitions = split
        if partitions < 1 or upper < lower:
            raise ValueError("a split needs at least one partition and lower <= upper")
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def write_options(
    url: str, table: str, props: Mapping[str, str], connections: int = 16, batch_size: int = 10_000
) -> dict[str, str]:
    """Writer options; ``connections`` caps how many tasks hold a connection at once."""
    return {
        "url": url, "dbtable": table, "batchsize": str(batch_size), "numPartitions": str(connections), **props,
    }


def read_jdbc(
    spark: SparkSession, url: str, table: str, props: Mapping[str, str], split: Bounds | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, props, split)).load()


def write_jdbc(df: DataFrame, url: str, table: str, props: Mapping[str, str], mode: str = "append") -> None:
    """Append rows to a table; a failed write raises."""
    df.write.format("jdbc").mode(mode).options(**write_options(url, table, props)).save()
