"""Tables that change by versions: readers see one version whole, before, during and after a write.

A table folder holds ``data/version=<label>/<partitions>`` and ``manifests/<number>``. A manifest is a Parquet table
with one row per live folder: the values of its partition, the label of the write that made it, and the number of its
rows. A partition has a folder for each write that added rows to it, at most ``FOLDERS`` and one for the rows written
last. Reading joins the data to a manifest on its partition columns, so Spark prunes folders at run time: those of labels, and of
partition values, that are not live at all. A replaced folder is opened only while its write has other live folders,
and its rows then fall to the join. A write adds a folder of data, then a manifest, which one rename makes the latest: what an interrupted
write leaves behind is in no manifest. Files of live or earlier versions are never changed; ``vacuum`` deletes those
that no kept manifest names. Two writers at once are told apart when the second renames: it fails and can be repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace as with_fields

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgemart.operators.dedup import latest_by_key, repeats_a_key, tie_break
from forgemart.operators.incremental import by_key
from forgemart.sources.files import Staged, child_names, delete, moved, staged, write_table

LABEL, ROWS = "version", "n_rows"
FOLDERS = 8  # a partition of that many folders is written anew when rows fall in it


class ConcurrentWrite(RuntimeError):
    """Another writer made this version first; nothing of this write is visible."""


@dataclass(frozen=True)
class Draft:
    """A written version that no reader sees until it is published."""

    path: str
    number: int
    manifest: DataFrame
    folder: str
    rows: int
    scratch: tuple[Staged, ...] = ()  # what its manifest reads


def current(spark: SparkSession, path: str) -> int | None:
    """Number of the latest version; None when the table has none."""
    return max((int(n) for n in child_names(spark, f"{path}/manifests") if n.isdigit()), default=None)


def manifest(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Live folders of a version, by default the latest: partition values, ``version`` and ``n_rows``."""
    stored = spark.read.parquet(f"{path}/manifests/{_number(spark, path, number):010d}")
    return stored.filter(F.col(ROWS) > 0)


def _number(spark: SparkSession, path: str, number: int | None) -> int:
    found = current(spark, path) if number is None else number
    if found is None:
        raise ValueError(f"no version of {path}")
    return found


def read(
    spark: SparkSession, path: str, schema: T.StructType | None = None, number: int | None = None
) -> DataFrame | None:
    """The rows of a version, by default the latest; None for an empty table without a given schema."""
    return _rows(spark, path, manifest(spark, path, number), schema)


def changes(
    spark: SparkSession, path: str, since: int, schema: T.StructType | None = None, number: int | None = None
) -> DataFrame | None:
    """The rows of the partitions written after version ``since``, as they are in version ``number``, by default the
    latest; no other partition is read.

    A changed row is among them; so are unchanged ones beside it.
    """
    live = manifest(spark, path, number)
    last = F.max(LABEL).over(Window.partitionBy(*[c for c in live.columns if c not in (LABEL, ROWS)]))
    written = live.withColumn("_last", last).filter(F.col("_last") >= f"v{since + 1:010d}").drop("_last")
    return _rows(spark, path, written, schema)


def _rows(
    spark: SparkSession, path: str, live: DataFrame, schema: T.StructType | None, labelled: bool = False
) -> DataFrame | None:
    parts = [c for c in live.columns if c not in (LABEL, ROWS)]
    reader = spark.read
    if schema is not None:
        typed = {f.name: f for f in schema}
        fields = [f for f in schema if f.name not in parts]
        fields += [T.StructField(LABEL, T.StringType()), *[typed.get(c, live.schema[c]) for c in parts]]
        reader = reader.schema(T.StructType(fields))
    try:
        data = reader.parquet(f"{path}/data")
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
    if LABEL not in data.columns:  # no write has stored a row
        data = data.withColumns({c: F.lit(None).cast(live.schema[c].dataType) for c in (LABEL, *parts)})
    keys = [LABEL, *parts]
    rows = data.join(live.select(*keys), keys, "left_semi")
    return rows if labelled else rows.drop(LABEL)


def replace(spark: SparkSession, path: str, df: DataFrame, parts: Sequence[str] = ()) -> int:
    """Make ``df`` the whole table; returns its number of rows. What ``df`` reads may be the table itself."""
    draft = prepare_replace(spark, path, df, parts)
    publish(spark, draft)
    return draft.rows


def prepare_replace(spark: SparkSession, path: str, df: DataFrame, parts: Sequence[str] = ()) -> Draft:
    """Write ``df`` as the whole table of the next version."""
    return _draft(spark, path, df, parts, (current(spark, path) or 0) + 1)


def merge(spark: SparkSession, path: str, new: DataFrame, key: Sequence[str], *args, **kwargs) -> None:
    """``prepare_merge`` and ``publish`` in one."""
    publish(spark, prepare_merge(spark, path, new, key, *args, **kwargs))


def publish(spark: SparkSession, draft: Draft) -> None:
    """Make a draft the latest version by one rename; ``ConcurrentWrite`` if there is one of its number."""
    folder = f"{draft.path}/manifests/_draft-{uuid.uuid4().hex}"
    draft.manifest.coalesce(1).write.parquet(folder)  # one row per folder of the table
    for stored in draft.scratch:
        stored.drop()
    if not moved(spark, folder, f"{draft.path}/manifests/{draft.number:010d}"):
        raise ConcurrentWrite(f"version {draft.number} of {draft.path} was made by another writer")


def discard(spark: SparkSession, draft: Draft) -> None:
    """Delete what a draft wrote, instead of publishing it."""
    delete(spark, draft.folder)
    for stored in draft.scratch:
        stored.drop()


def prepare_merge(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    key: Sequence[str],
    parts: Sequence[str] = (),
    order: Sequence[Column] = (),
    latest_wins: bool = False,
    stable: bool = False,
) -> Draft:
    """Write the table with ``new`` merged by key; the first merge creates it.

    Of several incoming rows the first by ``order`` counts. It replaces the stored row of its key; with
    ``latest_wins`` the first of both by ``order`` stays, so rows may come in any order and any number of times.
    Incoming rows are written to folders of their own. Of the stored ones a folder whose rows are all replaced is
    dropped unread, one that holds some replaced rows is written anew, and so are all folders of a partition that
    incoming rows fall in and that has ``FOLDERS`` of them. ``stable`` says that rows of a key share their partition,
    so the others need not be searched. ``new`` is read several times: pass a stored table. A null partition value
    fails the merge.
    """
    number = current(spark, path)
    new = new.withColumns({c: F.coalesce(c, F.raise_error(F.lit(f"{c} is null"))) for c in parts})
    live = None if number is None else manifest(spark, path, number)
    stored = None if live is None else _rows(spark, path, live, new.schema, True)
    repeated = repeats_a_key(new, key)
    incoming = latest_by_key(new, key, order) if repeated else new
    if stored is None:
        return _draft(spark, path, incoming, parts, (number or 0) + 1)
    scratch = []
    if repeated:
        scratch.append(staged(spark, incoming, "incoming"))  # read several times below
        incoming = scratch[0].frame
    if set(live.columns) != {*parts, LABEL, ROWS}:
        raise ValueError(f"{path} is not partitioned by {', '.join(parts) or 'nothing'}")
    folder = [LABEL, *parts]
    if parts and stable:
        here = live.join(incoming.select(*parts).distinct(), list(parts), "left_semi")
        stored = _rows(spark, path, here, new.schema, True)
    held = by_key(stored, incoming, key, "left_semi").groupBy(*folder).agg(F.count(F.lit(1)).alias("_held"))
    # One row per folder, here and below.
    scratch.append(staged(spark, held, "touched"))
    touched = scratch[-1].frame
    reached = incoming.select(*parts).distinct() if parts else spark.range(1).select()
    counted = live.withColumn("_folders", F.count(F.lit(1)).over(Window.partitionBy(*parts)))
    crowded = counted.filter(F.col("_folders") >= FOLDERS)
    crowded = (crowded.join(reached, list(parts), "left_semi") if parts else crowded).select(*folder, F.lit(True).alias("_full"))
    marked = live.join(touched, folder, "left").join(crowded, folder, "left")
    held, full = F.coalesce("_held", F.lit(0)), F.coalesce("_full", F.lit(False))
    gone = F.lit(False) if latest_wins else held >= F.col(ROWS)  # no row of the folder stays
    rewritten = marked.filter(~gone & ((held > 0) | full)).select(*live.columns)
    untouched = marked.filter((held == 0) & ~full).select(*live.columns)
    if rewritten.isEmpty():
        return with_fields(_draft(spark, path, incoming, parts, number + 1, untouched), scratch=tuple(scratch))
    old = _rows(spark, path, rewritten, new.schema).select(*new.columns)
    if latest_wins:
        result = _latest_of_both(old, incoming, key, order)
    else:
        result = by_key(old, incoming, key, "left_anti").unionByName(incoming)
    return with_fields(_draft(spark, path, result, parts, number + 1, untouched), scratch=tuple(scratch))


def _latest_of_both(old: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of each key of ``incoming`` the first row of both, and the rows of ``old`` that have none of these keys."""
    both = old.withColumn("_new", F.lit(False)).unionByName(incoming.withColumn("_new", F.lit(True)))
    same = Window.partitionBy(*key)
    ranked = both.withColumns({
        "_rank": F.row_number().over(same.orderBy(*order, *tie_break(old, key))),
        "_any_new": F.max("_new").over(same),
    })
    return ranked.filter((F.col("_rank") == 1) | ~F.col("_any_new")).select(*old.columns)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete data that none of the last ``keep`` versions names, and earlier manifests; the folders deleted.

    Run it when no reader holds an earlier version and no write is under way.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    numbers = sorted(int(n) for n in child_names(spark, f"{path}/manifests") if n.isdigit())
    kept = numbers[-keep:]
    labels: set[str] = set()
    for number in kept:
        rows = manifest(spark, path, number).select(LABEL).distinct().collect()  # one per write
        labels |= {f"{LABEL}={r[LABEL]}" for r in rows}
    dead = [f"{path}/manifests/{n}" for n in child_names(spark, f"{path}/manifests") if n not in {f"{k:010d}" for k in kept}]
    dead += [f"{path}/data/{n}" for n in child_names(spark, f"{path}/data") if n.startswith(LABEL) and n not in labels]
    for folder in dead:
        delete(spark, folder)
    return len(dead)


def _draft(
    spark: SparkSession, path: str, df: DataFrame, parts: Sequence[str], number: int, others: DataFrame | None = None
) -> Draft:
    """Write rows and draft the manifest that adds them to ``others``."""
    label = f"v{number:010d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/data/{LABEL}={label}"
    rows = write_table(df, folder, parts).get["rows"]
    typed = T.StructType([f for f in df.schema if f.name not in parts] + [df.schema[c] for c in parts])
    counts = spark.read.schema(typed).parquet(folder).groupBy(*parts).agg(F.count(F.lit(1)).alias(ROWS))
    fresh = counts.select(*parts, F.lit(label).alias(LABEL), ROWS)
    return Draft(path, number, fresh if others is None else others.unionByName(fresh), folder, rows)
