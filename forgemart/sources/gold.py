"""Loading the star schema into lake tables, dimensions first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from forgemart import schemas
from forgemart.operators import quality
from forgemart.operators.incremental import by_key, upsert
from forgemart.plans import star as build
from forgemart.plans.star import Star
from forgemart.sources.files import path_exists, staged, write_table
from forgemart.sources.lake import LakePaths, merge_table, read_table

# Fact table, the silver table it is made of, its natural key, the time that places it in a partition, and its other
# times.
_FACTS = {
    "fact_commits": ("commits", ["sha", "repository_id"], "authored_at", []),
    "fact_pull_requests": (
        "pull_requests", ["github_pr_id", "repository_id"], "created_at", ["merged_at", "closed_at"]
    ),
    "fact_issues": ("issues", ["github_issue_id", "repository_id"], "created_at", ["closed_at"]),
}
PARTITIONS = ("year", "month")
LOADS = "finished_loads"
_LOADS_DDL = """
    load_id STRING, finished_at TIMESTAMP, silver_versions MAP<STRING, BIGINT>, loaded MAP<STRING, BIGINT>,
    rejected MAP<STRING, BIGINT>"""


def load_star(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    paths: LakePaths,
    load_id: str,
    previous_id: str | None = None,
    start: date = build.CALENDAR_START,
    end: date = build.CALENDAR_END,
    part_cols: Sequence[str] = PARTITIONS,
    silver_versions: Mapping[str, int] | None = None,
    only_changes: bool = False,
) -> Star:
    """Store the star built from the silver tables and return it as stored.

    Each load writes its dimensions to a folder of its own; rows and keys of the load named ``previous_id``
    are carried over, by default those of the latest finished load. Stored facts hold keys, so a load that finds
    facts but no finished load is refused. The facts look their keys up in the stored dimensions and are merged by
    natural key into versioned tables, partitioned by ``part_cols`` (year, or year and month, of the event).

    Rows that break a constraint of their table go to ``rejected_<table>/load=<load_id>`` with all their reasons;
    languages of unknown repositories go there as they are. Silver records whose repository is unknown also go to
    ``quarantine_<entity>/load=<load_id>``. With ``only_changes`` the silver facts are those changed since the last
    load, and quarantined records of that load join them again, so a repository that lands later gets its facts.
    The calendar runs from ``start`` to ``end`` and further where any date of a fact lies outside, so that none is
    hidden from queries by day. ``silver_versions`` is kept with the finished load.
    """
    previous = previous_id or latest_load(spark, paths)
    if previous is None and any(path_exists(spark, paths.gold(name)) for name in _FACTS):
        raise ValueError("facts are stored but no finished load is known: name the load to go on from in previous_id")
    loaded: dict[str, int] = {}
    rejected: dict[str, int] = {}

    def of_load(name: str, load: str = load_id) -> str:
        return f"{paths.gold(name)}/load={load}"

    def dimension(name: str, make, key: str, unique: Sequence[Sequence[str]], own: str, nameless: DataFrame | None = None):
        before = None if previous is None else _stored(spark, name, of_load(name, previous))
        if before is not None and previous == load_id:
            before = staged(spark, before, name).frame  # a repeated load writes where it reads
        fresh = make(before)
        merged = fresh if before is None else upsert(before, fresh, [key])
        # Keys grow from load to load, so of two rows the one stored first stays.
        rows = staged(spark, quality.tagged(merged, quality.constraints(name), unique, [F.col(own)]), name)
        good = F.size("reasons") == 0
        write_table(rows.frame.filter(good).drop("reasons"), of_load(name))
        bad = rows.frame.filter(~good)
        if nameless is not None:
            reason = F.array(F.lit(f"{key} is null"))
            bad = bad.unionByName(nameless.withColumn("reasons", reason), allowMissingColumns=True)
        rejected[name] = write_table(bad, of_load(f"rejected_{name}")).get["rows"]
        loaded[name] = rows.rows
        rows.drop()
        return _stored(spark, name, of_load(name))

    sources = [build.contributor_users(silver["contributors"]), build.author_users(silver["commits"])]
    repo = dimension(
        "dim_repository",
        lambda before: build.dim_repository(silver["repositories"], before),
        "github_repo_id",
        [["github_repo_id"]],
        "repository_id",
        silver["repositories"].filter("github_repo_id IS NULL"),
    )
    user = dimension(
        "dim_user",
        lambda before: build.dim_user(sources, before),
        "login",
        [["github_user_id"]],
        "user_id",
        build.contributor_users(silver["contributors"]).filter("login IS NULL"),
    )
    make_fact = {
        "fact_commits": build.fact_commits,
        "fact_pull_requests": build.fact_pull_requests,
        "fact_issues": build.fact_issues,
    }
    for name, (entity, key, moment, others) in _FACTS.items():
        records, waiting = silver[entity], f"quarantine_{entity}"
        if only_changes and previous is not None:
            held = read_table(spark, of_load(waiting, previous), records.schema)
            if held is not None:
                held = staged(spark, held, waiting).frame if previous == load_id else held
                records = by_key(held, records, schemas.KEYS[entity], "left_anti").unionByName(records)
        known = repo.select(F.col("full_name").alias("repository_full_name")).distinct()
        write_table(records.join(known, "repository_full_name", "left_anti").select(*records.columns), of_load(waiting))
        times = {"year": F.year(moment), "month": F.month(moment)}
        fact = make_fact[name](records, repo, user).withColumns({c: times[c] for c in part_cols})
        rules = [*quality.constraints(name), (f"{moment} is null", F.col(moment).isNull())]
        rows = staged(spark, quality.tagged(fact, rules), name)
        good = rows.frame.filter(F.size("reasons") == 0).drop("reasons")
        bad = rows.frame.filter(F.size("reasons") > 0).drop(*part_cols)
        rejected[name] = write_table(bad, of_load(f"rejected_{name}")).get["rows"]
        loaded[name] = rows.rows - rejected[name]
        merge_table(spark, paths.gold(name), good, key, part_cols)
        days = good.agg(
            F.min(F.least(moment, *others) if others else moment).cast("date"),
            F.max(F.greatest(moment, *others) if others else moment).cast("date"),
        ).first()
        if days[0] is not None:
            start, end = min(start, days[0]), max(end, days[1])
        rows.drop()

    before = None if previous is None else _stored(spark, "dim_date", of_load("dim_date", previous))
    if before is not None and previous == load_id:
        before = staged(spark, before, "dim_date").frame
    days = build.dim_date(spark, start, end)
    write_table(days if before is None else upsert(before, days, ["date_id"]), of_load("dim_date"))
    languages = build.repo_languages(silver["languages"], repo)
    tagged = staged(spark, quality.tagged(languages, quality.constraints("repo_languages")), "repo_languages")
    write_table(tagged.frame.filter(F.size("reasons") == 0).drop("reasons"), of_load("repo_languages"))
    unknown = build.placed(silver["languages"], repo).filter("repository_id IS NULL").drop("repository_id")
    write_table(unknown, of_load("rejected_repo_languages"))
    loaded["repo_languages"] = tagged.rows
    stored = [_stored(spark, name, paths.gold(name)).drop(*part_cols) for name in _FACTS]
    row = [(load_id, datetime.now(timezone.utc), dict(silver_versions or {}), loaded, rejected)]
    spark.createDataFrame(row, _LOADS_DDL).coalesce(1).write.mode("append").parquet(paths.gold(LOADS))
    return Star(
        repo,
        user,
        _stored(spark, "dim_date", of_load("dim_date")),
        *stored,
        _stored(spark, "repo_languages", of_load("repo_languages")),
    )


def finished_load(spark: SparkSession, paths: LakePaths, load_id: str | None = None) -> Row | None:
    """What is kept of a finished load, by default of the one that finished last; None when there is none."""
    loads = read_table(spark, paths.gold(LOADS), schemas.struct(_LOADS_DDL))
    if loads is None:
        return None
    if load_id is not None:
        loads = loads.filter(F.col("load_id") == load_id)
    return loads.orderBy(F.desc("finished_at")).limit(1).first()


def latest_load(spark: SparkSession, paths: LakePaths) -> str | None:
    """The id of the load that finished last; None before the first."""
    found = finished_load(spark, paths)
    return None if found is None else found["load_id"]


def _stored(spark: SparkSession, table: str, path: str) -> DataFrame | None:
    return read_table(spark, path, schemas.gold(table))
