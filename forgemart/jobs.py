"""The batch jobs: payloads to bronze, bronze to silver, and silver to gold. Each adds a row to the run log."""

from __future__ import annotations

import traceback
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemart import schemas
from forgemart.plans import bronze, silver
from forgemart.plans.star import Star
from forgemart.session import configure
from forgemart.sources import gold, lake, versions
from forgemart.sources.files import counted_rows


class Run:
    """Counts and errors of one run of a job, for its row in the run log."""

    def __init__(self, run_id: str | None):
        self.started = datetime.now(timezone.utc)
        self.run_id = run_id or f"{self.started:%Y%m%dT%H%M%S%f}"
        self.counts: dict[str, int] = {}
        self.errors: list[str] = []


@contextmanager
def _logged(spark: SparkSession, paths: lake.LakePaths, run_id: str | None) -> Iterator[Run]:
    """A run that is logged however it ends; a failed one with its error, which is raised again."""
    configure(spark)
    run = Run(run_id)
    try:
        yield run
    except Exception as error:
        run.errors.append(traceback.format_exception_only(error)[-1].strip().splitlines()[0])
        _log(spark, paths, run, "failed")
        raise
    _log(spark, paths, run, "completed_with_errors" if run.errors else "completed")


def _log(spark: SparkSession, paths: lake.LakePaths, run: Run, status: str) -> None:
    totals = {entity: run.counts.get(entity, 0) for entity in schemas.ENTITIES}
    of = totals.get
    row = (
        run.run_id,
        run.started,
        datetime.now(timezone.utc),
        status,
        of("repositories"),
        totals,
        of("commits"),
        of("pull_requests"),
        of("issues"),
        sorted(run.errors),
    )
    bronze.append_run_log(spark.createDataFrame([row], schemas.RUN_LOG_DDL).coalesce(1), paths.run_log())


def ingest(
    spark: SparkSession,
    paths: lake.LakePaths,
    payloads: Mapping[str, DataFrame],
    landed: date,
    run_id: str | None = None,
    commits_since: datetime | Column | None = None,
) -> dict[str, int]:
    """Land API payloads: texts in a column ``payload``, by entity. Returns the records landed per entity.

    Payloads that are no JSON of their entity go to ``rejected_<entity>/run=<run_id>`` below the bronze folder, pull
    requests in the issue feed are left out, and ``commits_since`` keeps commits from a moment on. An entity that
    fails is noted in the run log, counts 0 and doesn't keep the others from landing.
    """
    with _logged(spark, paths, run_id) as run:
        for entity in schemas.ENTITIES:
            if entity not in payloads:
                continue
            try:
                parsed = bronze.parse_payloads(payloads[entity].select("payload"), entity)
                # The unreadable are counted while the others land; texts are parsed again only to keep those apart.
                unreadable = F.count_if(F.col("_corrupt_record").isNotNull())
                counted, seen = counted_rows(parsed, f"unreadable_{entity}", unreadable)
                records = bronze.normalize(entity, bronze.split_corrupt(counted)[0])
                if entity == "commits" and commits_since is not None:
                    records = bronze.since_filter(records, "author_date", commits_since)
                landing = lake.write_bronze(records, paths, entity, landed)
                bad = bronze.split_corrupt(parsed)[1].select("_corrupt_record")
                bad = bad if seen.get["rows"] else bad.limit(0)
                rejected = _kept_apart(bad, paths.bronze(f"rejected_{entity}"), run, entity)
                run.counts[entity] = landing.get["rows"]
            except PySparkException as error:
                run.counts[entity] = 0
                run.errors.append(f"{entity}: {error.getCondition() or type(error).__name__}")
                continue
            if rejected:
                run.errors.append(f"{entity}: {rejected} unreadable payloads")
    return run.counts


def _kept_apart(bad: DataFrame, path: str, run: Run, name: str) -> int:
    counted, seen = lake.counted_rows(bad, f"rejected_{name}")
    counted.write.mode("overwrite").json(f"{path}/run={run.run_id}")
    return seen.get["rows"]


def _unreadable(paths: lake.LakePaths, run: Run, entity: str, bad: DataFrame) -> int:
    rejected = _kept_apart(bad, paths.silver(f"rejected_{entity}"), run, entity)
    if rejected:
        run.errors.append(f"{entity}: {rejected} unreadable records")
    return rejected


def bronze_to_silver(
    spark: SparkSession,
    paths: lake.LakePaths,
    since: date | None = None,
    multi_line: bool = False,
    incremental: bool = False,
    run_id: str | None = None,
) -> dict[str, int]:
    """Clean every entity that has landed; rows read into silver per entity, missing entities left out.

    ``since`` reads the landing days from then on only. With it or with ``incremental`` every entity is merged into
    its silver table by key; a silver table is replaced only when all landings are read. Silver tables are versioned:
    readers see them before or after, never in between. Unreadable records of a run go to
    ``rejected_<entity>/run=<run_id>`` as they are, and an entity of which nothing can be read fails the job
    before any table is touched.
    """
    merge = incremental or since is not None
    with _logged(spark, paths, run_id) as run:
        landed = {}
        for entity in schemas.ENTITIES:
            records = lake.read_bronze(spark, paths, entity, since, multi_line)
            if records is None:
                continue
            landed[entity] = records
            if not bronze.split_corrupt(records)[0].take(1):
                for name, texts in landed.items():
                    _unreadable(paths, run, name, bronze.split_corrupt(texts)[1])
                raise ValueError(f"no readable record of {entity}: files of whole documents need multi_line=True")
        for entity, records in landed.items():
            parts, path = silver.partition_columns(entity), paths.silver(entity)

            def written(good: DataFrame) -> lake.Staged | versions.Draft:
                cleaned = silver.clean(entity, good)
                return lake.staged(spark, cleaned, entity) if merge else versions.prepare_replace(spark, path, cleaned, parts)

            # The unreadable are counted while the others are cleaned; texts are parsed again only if there are any. A
            # record is unreadable by any of its fields, so the count asks for all.
            whole = F.length(F.to_json(F.struct(*records.columns))) >= 0
            unreadable = F.count_if(F.col("_corrupt_record").isNotNull() & whole)
            counted, seen = lake.counted_rows(records, f"unreadable_{entity}", unreadable)
            table = written(bronze.split_corrupt(counted)[0])
            good, bad = bronze.split_corrupt(records)
            # Of a table without rows the counter may be lost.
            if _unreadable(paths, run, entity, bad if seen.get["rows"] or not table.rows else bad.limit(0)):
                table.drop() if merge else versions.discard(spark, table)
                table = written(good)  # records with faults only in fields that silver doesn't read are in it
            if merge:
                lake.merge_table(spark, path, table.frame, schemas.KEYS[entity], parts)
                table.drop()
            else:
                versions.publish(spark, table)
            run.counts[entity] = table.rows
    return run.counts


def silver_to_gold(
    spark: SparkSession,
    paths: lake.LakePaths,
    load_id: str,
    previous_id: str | None = None,
    incremental: bool = False,
) -> Star:
    """Load the star schema from the silver tables; an entity without a table counts as empty.

    Keys go on from ``previous_id`` or, without it, from the latest finished load. ``incremental`` reads of each
    fact's silver table only the months written since that load, and tries again the records that it left without a
    repository; facts already stored keep the author they were given.
    """
    with _logged(spark, paths, load_id) as run:
        before = gold.finished_load(spark, paths, previous_id)
        marks = (before["silver_versions"] or {}) if incremental and before is not None else {}
        tables, read = {}, {}
        for entity in schemas.ENTITIES:
            path, found = paths.silver(entity), None
            number = versions.current(spark, path)
            if number is None:
                found = lake.read_silver(spark, paths, entity)
            else:
                read[entity] = number
                blank = silver.empty(spark, entity).schema
                if entity in marks and entity in schemas.EVENT_TIME:
                    found = versions.changes(spark, path, marks[entity], blank, number)
                else:
                    found = versions.read(spark, path, blank, number)
            tables[entity] = silver.empty(spark, entity) if found is None else found
        star = gold.load_star(
            spark, tables, paths, load_id, previous_id, silver_versions=read, only_changes=incremental
        )
        done = gold.finished_load(spark, paths, load_id)
        for name, entity in schemas.GOLD_SOURCES.items():
            run.counts[entity] = done["loaded"][name]
        run.errors += [f"{name}: {n} rows rejected" for name, n in done["rejected"].items() if n]
    return star
