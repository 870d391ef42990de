"""The star schema: calendar, repository and user dimensions, and the facts that refer to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemart import schemas
from forgemart.functions import times
from forgemart.operators import keys
from forgemart.operators.dedup import latest_by_key

# The default calendar.
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2030, 12, 31)

_USER_COLUMNS = ["github_user_id", "login", "avatar_url", "user_type", "html_url"]


@dataclass(frozen=True)
class Star:
    repo: DataFrame
    user: DataFrame
    date: DataFrame
    commits: DataFrame
    prs: DataFrame
    issues: DataFrame
    languages: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_repository": self.repo,
            "dim_user": self.user,
            "dim_date": self.date,
            "fact_commits": self.commits,
            "fact_pull_requests": self.prs,
            "fact_issues": self.issues,
            "repo_languages": self.languages,
        }


def with_defaults(table: str, df: DataFrame) -> DataFrame:
    """All columns of a gold table, those ``df`` lacks with their default; a null that is given stays null."""
    defaults = schemas.DEFAULTS[table]
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name)
            for f in schemas.gold(table)
        ]
    )


def calendar_of(days: DataFrame, column: str, padded_names: bool = False) -> DataFrame:
    """Calendar attributes of a frame of dates.

    ``padded_names`` blank-pads month and day names to nine characters.
    """
    def name(pattern: str) -> Column:
        text = F.date_format(column, pattern)
        return F.rpad(text, 9, " ") if padded_names else text

    day = F.col(column)
    return days.select(
        times.date_id(day).alias("date_id"),
        day.cast("date").alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        name("MMMM").alias("month_name"),
        F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day_of_month"),
        times.day_of_week(day).alias("day_of_week"),
        name("EEEE").alias("day_name"),
        (times.day_of_week(day) >= 5).alias("is_weekend"),
    )


def dim_date(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END, padded_names: bool = False
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    if end < start:
        raise ValueError("the calendar ends before it starts")
    span = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    return calendar_of(spark.range(1).select(F.explode(span).alias("day")), "day", padded_names)


def calendar_spanning(facts: DataFrame, column: str) -> DataFrame:
    """The calendar from the earliest to the latest day in ``facts``."""
    ends = facts.agg(F.min(column).cast("date").alias("first"), F.max(column).cast("date").alias("last"))
    days = F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY")))
    return calendar_of(ends.filter(F.col("first").isNotNull()).select(days.alias("day")), "day")


def extend_calendar(existing: DataFrame, spark: SparkSession, start: date, end: date) -> DataFrame:
    """Add the days of a range that are not there yet; running it twice changes nothing."""
    fresh = dim_date(spark, start, end).join(existing.select("date_id"), "date_id", "left_anti")
    return existing.unionByName(fresh)


def dim_repository(silver: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Repositories with surrogate keys and a load stamp; keys already given out in ``existing`` stay.

    Rows without an id cannot be told apart between loads and are left out.
    """
    silver = silver.filter(F.col("github_repo_id").isNotNull())
    if existing is None:
        keyed = keys.numbered(silver, "github_repo_id", "repository_id")
    else:
        keyed = keys.with_kept_keys(existing, silver, "github_repo_id", "repository_id")
    return keyed.select("repository_id", *silver.columns, F.current_timestamp().alias("etl_loaded_at"))


def contributor_users(contributors: DataFrame) -> DataFrame:
    return contributors.select(*_USER_COLUMNS)


def author_users(records: DataFrame, login: str = "author_login") -> DataFrame:
    """Users known only by the login on their records."""
    return records.select(F.col(login).alias("login")).distinct().select(
        F.lit(None).cast("bigint").alias("github_user_id"),
        "login",
        F.lit(None).cast("string").alias("avatar_url"),
        F.lit("User").alias("user_type"),
        F.lit(None).cast("string").alias("html_url"),
    )


def dim_user(sources: Sequence[DataFrame], existing: DataFrame | None = None) -> DataFrame:
    """Union of user sources, one row per login; a row with a known user id beats a bare login.

    Every source has the user columns without a key. Rows without a login cannot be referred to and are left
    out. A user whose id ``existing`` knows keeps that row when the sources have the bare login only.
    """
    everyone = reduce(DataFrame.unionByName, sources).filter(F.col("login").isNotNull())
    users = latest_by_key(everyone, ["login"], [F.col("github_user_id").asc_nulls_last()])
    if existing is None:
        keyed = keys.numbered(users, "login", "user_id")
    else:
        bare = F.col("github_user_id").isNull()
        stored = existing.filter(~bare).select(*_USER_COLUMNS)
        users = (
            users.filter(~bare)
            .unionByName(users.filter(bare).join(stored.select("login"), "login", "left_anti").select(*_USER_COLUMNS))
            .unionByName(stored.join(users.filter(bare).select("login"), "login", "left_semi"))
        )
        keyed = keys.with_kept_keys(existing, users, "login", "user_id")
    return keyed.select("user_id", *_USER_COLUMNS, F.current_timestamp().alias("etl_loaded_at"))


def resolve_keys(fact: DataFrame, repo: DataFrame, user: DataFrame) -> DataFrame:
    """Add ``repository_id`` and ``author_id``; what is unknown stays null for the orphan check to report."""
    return keys.lookup(placed(fact, repo), user, "login", "author_login", "user_id", "author_id")


def placed(records: DataFrame, repo: DataFrame) -> DataFrame:
    """Add ``repository_id``. A name shared by two repositories means the younger, so no record doubles."""
    newest = F.max_by("repository_id", F.struct("created_at", "repository_id"))
    named = repo.groupBy("full_name").agg(newest.alias("repository_id"))
    return keys.lookup(records, named, "full_name", "repository_full_name", "repository_id", "repository_id")


def fact_commits(silver: DataFrame, repo: DataFrame, user: DataFrame) -> DataFrame:
    resolved = resolve_keys(silver, repo, user)
    return keys.lookup(resolved, user, "login", "committer_login", "user_id", "committer_id").select(
        keys.row_handle("sha", "repository_full_name").alias("commit_id"),
        "sha",
        "repository_id",
        "author_id",
        "committer_id",
        times.date_id(F.col("author_date")).alias("date_id"),
        "message",
        "additions",
        "deletions",
        "files_changed",
        (F.col("additions") - F.col("deletions")).alias("net_lines"),
        F.col("author_date").alias("authored_at"),
    )


def fact_pull_requests(silver: DataFrame, repo: DataFrame, user: DataFrame) -> DataFrame:
    return resolve_keys(silver, repo, user).select(
        keys.row_handle("github_pr_id", "repository_full_name").alias("pr_id"),
        "github_pr_id",
        "number",
        "repository_id",
        "author_id",
        *_date_keys("created", "merged", "closed"),
        "title",
        "state",
        "is_merged",
        F.col("draft").alias("is_draft"),
        "comments_count",
        "review_comments_count",
        "commits_count",
        "additions",
        "deletions",
        "changed_files",
        "created_at",
        "merged_at",
        "closed_at",
        "time_to_merge_hours",
    )


def fact_issues(silver: DataFrame, repo: DataFrame, user: DataFrame) -> DataFrame:
    return resolve_keys(silver, repo, user).select(
        keys.row_handle("github_issue_id", "repository_full_name").alias("issue_id"),
        "github_issue_id",
        "number",
        "repository_id",
        "author_id",
        *_date_keys("created", "closed"),
        "title",
        "state",
        "comments_count",
        "labels",
        "assignees",
        "milestone",
        "created_at",
        "closed_at",
        "time_to_close_hours",
    )


def _date_keys(*events: str) -> list[Column]:
    return [times.date_id(F.col(f"{event}_at")).alias(f"{event}_date_id") for event in events]


def language_shares(silver: DataFrame) -> DataFrame:
    """One row per repository and language with its share of the repository's bytes."""
    total = F.col("total_bytes")
    return (
        silver.select("repository_full_name", "total_bytes", F.explode("languages").alias("language", "bytes"))
        .filter(F.col("bytes").isNotNull())
        .withColumn("percentage", F.when(total > 0, F.col("bytes") / total * 100).otherwise(0.0))
        .drop("total_bytes")
    )


def repo_languages(silver: DataFrame, repo: DataFrame) -> DataFrame:
    return placed(language_shares(silver), repo).select(
        keys.row_handle("repository_full_name", "language").alias("id"),
        "repository_id",
        "language",
        "bytes",
        "percentage",
    )


def build_star(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
    include_pr_issue_authors: bool = False,
) -> Star:
    """All gold tables from the six silver tables; dimensions first, as the facts look keys up in them."""
    repo = dim_repository(silver["repositories"])
    sources = [contributor_users(silver["contributors"]), author_users(silver["commits"])]
    if include_pr_issue_authors:
        sources += [author_users(silver["pull_requests"]), author_users(silver["issues"])]
    user = dim_user(sources)
    return Star(
        repo=repo,
        user=user,
        date=dim_date(spark, start, end),
        commits=fact_commits(silver["commits"], repo, user),
        prs=fact_pull_requests(silver["pull_requests"], repo, user),
        issues=fact_issues(silver["issues"], repo, user),
        languages=repo_languages(silver["languages"], repo),
    )
