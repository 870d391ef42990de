"""Files and folders behind any Hadoop path, and writes that count their rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forgemart.session import scratch_path


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = file_system(spark, path)
    return files.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none when it does not exist."""
    files, hadoop_path = file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(hadoop_path)] if files.exists(hadoop_path) else []


def delete(spark: SparkSession, path: str) -> None:
    files, hadoop_path = file_system(spark, path)
    files.delete(hadoop_path, True)


def make_folder(spark: SparkSession, path: str) -> None:
    files, hadoop_path = file_system(spark, path)
    files.mkdirs(hadoop_path)


def moved(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder unless the target is there already."""
    files, hadoop_path = file_system(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    if files.exists(goal) or not files.rename(hadoop_path, goal):
        return False
    # A folder that was there after all takes the new one in.
    return not files.exists(spark._jvm.org.apache.hadoop.fs.Path(goal, hadoop_path.getName()))


def write_table(
    df: DataFrame, path: str, part_cols: Sequence[str] = (), mode: str = "overwrite", only_touched: bool = False
) -> RowCount:
    """Write Parquet and count the rows while they pass.

    A partitioned table is rebalanced on its partition columns first: small partitions are packed into few
    files and a partition that holds most rows is split over many tasks. ``only_touched`` replaces just the
    partitions present in ``df``.
    """
    counted, seen = counted_rows(df, path)
    if part_cols:
        counted = counted.hint("rebalance", *[F.col(c) for c in part_cols])
    writer = counted.write.mode(mode)
    writer = writer.option("partitionOverwriteMode", "dynamic" if only_touched else "static")
    if part_cols:
        writer = writer.partitionBy(*part_cols)
    writer.parquet(path)
    return seen


@dataclass(frozen=True)
class Staged:
    frame: DataFrame
    rows: int
    path: str

    def drop(self) -> None:
        """Delete what was stored; the frame can't be read any more."""
        delete(self.frame.sparkSession, self.path)


def staged(spark: SparkSession, df: DataFrame, name: str) -> Staged:
    """Store a frame in the scratch folder, for several passes over it that do not compute it again."""
    path = scratch_path(spark, name)
    rows = write_table(df, path).get["rows"]
    return Staged(spark.read.schema(df.schema).parquet(path), rows, path)


class RowCount:
    """The rows seen by an action, in ``get["rows"]`` after it."""

    def __init__(self, seen: Observation):
        self._seen = seen

    @property
    def get(self) -> dict[str, int]:
        try:
            return self._seen.get
        except Py4JJavaError as error:
            # A plan that turns out empty while it runs is cut together with its counter.
            if "AssertionError" not in str(error.java_exception):
                raise
            return {"rows": 0}


def counted_rows(df: DataFrame, name: str, count: Column | None = None) -> tuple[DataFrame, RowCount]:
    """Count rows while they pass, by default all; read ``get['rows']`` after the action."""
    seen = Observation(name)
    return df.observe(seen, (F.count(F.lit(1)) if count is None else count).alias("rows")), RowCount(seen)
