"""Commit activity: timelines, contributors, heatmap."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgemart.functions import numbers, times
from forgemart.functions.numbers import long_sum
from forgemart.plans import params
from forgemart.plans.star import Star


def _activity() -> list[Column]:
    return [
        F.count("commit_id").alias("commit_count"),
        F.count_distinct("author_id").alias("unique_authors"),
        long_sum(F.col("additions")).alias("additions"),
        long_sum(F.col("deletions")).alias("deletions"),
    ]


def daily_commit_activity(star: Star) -> DataFrame:
    """Per day and repository: commits, distinct authors and lines, with the day's calendar attributes."""
    per_day = star.commits.groupBy("date_id", "repository_id").agg(*_activity())
    return (
        per_day.join(star.date, "date_id")
        .join(star.repo.select("repository_id", F.col("full_name").alias("repository")), "repository_id")
        .select(
            "full_date", "year", "month", "day_name", "is_weekend", "repository",
            "commit_count", "unique_authors", "additions", "deletions",
        )
        .orderBy("full_date", "repository")
    )


def commit_timeline(
    star: Star, period: str = "daily", limit: int = 90, repository_id: int | None = None
) -> DataFrame:
    """Commits, distinct authors and lines of the last ``limit`` periods that have commits."""
    params.one_of("period", period, tuple(times.PERIODS))
    params.between("limit", limit, 7, 365)
    dated = params.where_equal(star.commits, repository_id=repository_id).join(
        star.date.select("date_id", times.period_start(period, F.col("full_date")).alias("date")), "date_id"
    )
    return params.last_periods(dated.groupBy("date").agg(*_activity()), limit)


def total_commits(star: Star, repository_id: int | None = None) -> DataFrame:
    commits = params.where_equal(star.commits, repository_id=repository_id)
    return commits.agg(F.count(F.lit(1)).alias("total_commits"))


def top_contributors(star: Star, repository_id: int | None = None, limit: int | None = None) -> DataFrame:
    """Users by number of commits, ties by login; ``limit`` (1 to 100) keeps the first ones."""
    if limit is not None:
        params.between("limit", limit, 1, 100)
    per_user = (
        params.where_equal(star.commits, repository_id=repository_id)
        .filter(F.col("author_id").isNotNull())
        .groupBy(F.col("author_id").alias("user_id"))
        .agg(
            F.count("commit_id").alias("total_commits"),
            F.count_distinct("repository_id").alias("repos_contributed_to"),
            long_sum(F.col("additions")).alias("total_additions"),
            long_sum(F.col("deletions")).alias("total_deletions"),
            F.min("authored_at").alias("first_commit"),
            F.max("authored_at").alias("last_commit"),
        )
    )
    ranked = (
        star.user.select("user_id", "login", "avatar_url")
        .join(per_user, "user_id")
        .drop("user_id")
        .orderBy(F.col("total_commits").desc(), "login")
    )
    return ranked if limit is None else ranked.limit(limit)


def contributor_shares(star: Star, repository_id: int | None = None, limit: int = 10) -> DataFrame:
    """Rank of each of the top contributors and commits as a percentage of the first one's.

    At most 100 rows are ranked, so ranking them in one place is cheap.
    """
    top = top_contributors(star, repository_id, limit)
    order = Window.orderBy(F.col("total_commits").desc(), "login")
    everyone = Window.partitionBy()
    return top.select(
        F.row_number().over(order).alias("rank"),
        "login",
        "total_commits",
        (F.col("total_commits") / F.max("total_commits").over(everyone) * 100).alias("share_of_top"),
    )


def commit_heatmap(
    star: Star, repository_id: int | None = None, year: int | None = None, dense: bool = False
) -> DataFrame:
    """Commits per weekday (0 is Monday) and hour; ``dense`` adds the empty cells of the 7 x 24 grid."""
    commits = params.where_equal(star.commits, repository_id=repository_id)
    if year is not None:
        # Follows from the calendar condition, but reaches the scan of the fact.
        commits = commits.filter(F.col("date_id").between(year * 10000, year * 10000 + 9999))
    days = params.where_equal(star.date, year=year).select("date_id", "day_of_week", "day_name")
    cells = (
        commits.join(days, "date_id")
        .groupBy("day_of_week", "day_name", F.hour("authored_at").alias("hour"))
        .agg(F.count(F.lit(1)).alias("commit_count"))
    )
    if not dense:
        return cells.orderBy("day_of_week", "hour")
    spark = star.commits.sparkSession
    grid = spark.range(7 * 24).select(
        F.floor(F.col("id") / 24).cast("int").alias("day_of_week"), (F.col("id") % 24).cast("int").alias("hour")
    )
    return (
        grid.join(cells.drop("day_name"), ["day_of_week", "hour"], "left")
        .select("day_of_week", "hour", F.coalesce("commit_count", F.lit(0).cast("bigint")).alias("commit_count"))
        .orderBy("day_of_week", "hour")
    )


def heat_levels(cells: DataFrame) -> DataFrame:
    """Level 0 for empty cells, else 1 to 5 by share of the busiest of the at most 168 cells."""
    ratio = F.col("commit_count") / F.max("commit_count").over(Window.partitionBy())
    level = F.when(F.col("commit_count") == 0, 0)
    # Upper bounds of levels 1 to 4.
    for number, bound in enumerate((0.15, 0.35, 0.60, 0.80), start=1):
        level = level.when(ratio < bound, number)
    return cells.withColumn("level", level.otherwise(5))


def recent_commits(star: Star, as_of: Column | None = None, days: int = 30) -> DataFrame:
    """Number of commits since ``days`` days before ``as_of`` (now by default)."""
    moment = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    start = moment - F.make_dt_interval(F.lit(days))
    # A filter, not a conditional count: it reaches the scan and skips older files.
    return star.commits.filter(F.col("authored_at") >= start).agg(F.count(F.lit(1)).alias("recent_commits"))


def dense_commit_timeline(star: Star, as_of: date | None = None, days: int = 30) -> DataFrame:
    """Daily activity from ``days`` days before ``as_of`` (today by default) to it, days without commits too."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    first = F.date_sub(today, days)
    span = star.date.filter(F.col("full_date").between(first, today)).select("date_id", "full_date")
    # The calendar range as a range of keys prunes the fact before it is counted.
    in_range = F.col("date_id").between(times.date_id(first), times.date_id(today))
    per_day = star.commits.filter(in_range).groupBy("date_id").agg(*_activity())
    zero = F.lit(0).cast("bigint")
    counts = ["commit_count", "unique_authors", "additions", "deletions"]
    return (
        span.join(per_day, "date_id", "left")
        .select(F.col("full_date").alias("date"), *[F.coalesce(F.col(c), zero).alias(c) for c in counts])
        .orderBy("date")
    )


def share_of_all(df: DataFrame, value: str, name: str) -> DataFrame:
    """``value`` as a rounded percentage of its grand total; null when the total is zero."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, numbers.one_place(F.col(value) * F.lit(100.0) / F.nullif(total, F.lit(0))))
