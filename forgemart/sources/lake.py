"""Bronze JSON and silver Parquet in a lake folder, local or on an object store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from forgemart import schemas
from forgemart.operators.dedup import latest_by_key
from forgemart.operators.incremental import touched_partitions, upsert
from forgemart.sources import versions
from forgemart.sources.files import RowCount, Staged, counted_rows, delete, path_exists, staged, write_table

LANDED = ("year", "month", "day")
# Bronze files are compressed and then read by one task each: their records are bounded.
RECORDS_PER_FILE = 100_000


@dataclass(frozen=True)
class LakePaths:
    """Where layers live; the root may be any Hadoop path, such as ``/data`` or ``s3a://bucket``."""

    root: str
    bronze_prefix: str = "bronze"
    silver_prefix: str = "silver"
    gold_prefix: str = "gold"

    def bronze(self, entity: str) -> str:
        return f"{self.root.rstrip('/')}/{self.bronze_prefix}/{entity}"

    def silver(self, entity: str) -> str:
        return f"{self.root.rstrip('/')}/{self.silver_prefix}/{entity}"

    def run_log(self) -> str:
        return f"{self.root.rstrip('/')}/run_log"

    def gold(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.gold_prefix}/{table}"


def read_bronze(
    spark: SparkSession, paths: LakePaths, entity: str, since: date | None = None, multi_line: bool = False
) -> DataFrame | None:
    """Landed records of an entity with their ``year``, ``month``, ``day`` partition; None when there are none.

    ``multi_line=True`` reads whole-document files, one object or one array per file; Spark cannot split
    those, so land large feeds with :func:`write_bronze`, whose line-per-record files it can. Lines that do
    not fit the schema come back with ``_corrupt_record`` set. ``since`` prunes partitions.
    """
    schema = schemas.struct(schemas.BRONZE_DDL[entity] + ", _corrupt_record STRING")
    path = paths.bronze(entity)
    if not path_exists(spark, path):
        return None
    df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    if any(c not in df.columns for c in LANDED):
        return None  # a folder without partitions holds no landed files
    if since is not None:
        y, m, d = (F.col(c) for c in LANDED)
        df = df.filter(
            (y > since.year)
            | ((y == since.year) & ((m > since.month) | ((m == since.month) & (d >= since.day))))
        )
    return None if df.isEmpty() else df


def write_bronze(df: DataFrame, paths: LakePaths, entity: str, landed: date, mode: str = "append") -> RowCount:
    """Land records as compressed JSON lines below ``year=/month=/day=``."""
    stamped = df.withColumns(
        {
            "year": F.lit(f"{landed:%Y}"),
            "month": F.lit(f"{landed:%m}"),
            "day": F.lit(f"{landed:%d}"),
        }
    )
    counted, seen = counted_rows(stamped, f"bronze_{entity}")
    writer = counted.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer = writer.option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.partitionBy(*LANDED).option("ignoreNullFields", False).json(paths.bronze(entity))
    return seen


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A stored table, of a versioned one the latest version; None when it does not exist, or has neither files nor
    a given schema.

    A damaged table raises.
    """
    if not path_exists(spark, path):
        return None
    if versions.current(spark, path) is not None:
        return versions.read(spark, path, schema)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def read_silver(spark: SparkSession, paths: LakePaths, entity: str) -> DataFrame | None:
    return read_table(spark, paths.silver(entity))


def write_silver(
    df: DataFrame,
    paths: LakePaths,
    entity: str,
    part_cols: Sequence[str] = (),
    mode: str = "overwrite",
    only_touched: bool = False,
) -> RowCount:
    """Write a silver table; the returned observation holds the row count of that same pass."""
    return write_table(df, paths.silver(entity), part_cols, mode, only_touched)


def load_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table: one row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in frames.items()
    ]
    report = counts[0]
    for count in counts[1:]:
        report = report.unionByName(count)
    return report


def upsert_table(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    key: Sequence[str],
    part_cols: Sequence[str],
    order: Sequence[Column] = (),
) -> None:
    """Merge rows into a partitioned table by key, rewriting only the partitions that change.

    ``new`` is read several times, so pass a stored table. The merged partitions are first written to the
    scratch folder: the table is never read while it is overwritten. Running the same delta again changes
    nothing. A null partition value fails the job. A table without partitions is rewritten as a whole.
    """
    new = new.withColumns({c: F.coalesce(c, F.raise_error(F.lit(f"{c} is null"))) for c in part_cols})
    table = read_table(spark, path)
    if table is None:
        write_table(latest_by_key(new, key, order), path, part_cols)
        return
    incoming = new.select(*table.columns)
    if not part_cols:
        merged = upsert(table, incoming, key, order).select(*table.columns)
        write_table(staged(spark, merged, "upsert").frame, path)
        return
    stored = touched_partitions(table, incoming, key, part_cols)
    result = staged(spark, upsert(stored, incoming, key, order).select(*table.columns), "upsert").frame
    # A partition all of whose rows moved elsewhere has nothing to overwrite it with. These frames hold one
    # row per partition of the table.
    emptied = stored.select(*part_cols).distinct().join(
        result.select(*part_cols).distinct(), list(part_cols), "left_anti"
    ).collect()
    write_table(result, path, part_cols, only_touched=True)
    for row in emptied:
        delete(spark, path + "".join(f"/{c}={row[c]}" for c in part_cols))


def upsert_silver(
    spark: SparkSession,
    paths: LakePaths,
    entity: str,
    new: DataFrame,
    key: Sequence[str],
    part_cols: Sequence[str],
    order: Sequence[Column] = (),
) -> None:
    upsert_table(spark, paths.silver(entity), new, key, part_cols, order)


def merge_table(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    key: Sequence[str],
    part_cols: Sequence[str],
    order: Sequence[Column] = (),
) -> None:
    """Merge rows by key into a versioned table, see ``versions.merge``; a plain Parquet table becomes its first
    version."""
    if versions.current(spark, path) is None:
        plain = read_table(spark, path)
        if plain is not None:
            versions.replace(spark, path, plain, part_cols)
    versions.merge(spark, path, new, key, part_cols, order)
