"""Stored daily counts of commits that add up to any period, distinct authors included.

A row holds the commits of a day, a repository and a range of 32,768 author keys: their number and lines, and the
authors as a bitmap. Counts and lines add; bitmaps of one range are united, and the bits of a period's ranges are its
distinct authors, exactly. Queries over long periods read these rows in place of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemart.functions import times
from forgemart.functions.numbers import long_sum
from forgemart.plans import params
from forgemart.plans.star import Star

_COUNTS = ["commit_count", "additions", "deletions"]


def daily_partials(commits: DataFrame) -> DataFrame:
    """date_id, repository_id, author_range, commit_count, additions, deletions, authors (a bitmap).

    Commits without an author are in the rows without a range. Author keys are positive.
    """
    author = F.col("author_id")
    return commits.groupBy("date_id", "repository_id", F.bitmap_bucket_number(author).alias("author_range")).agg(
        F.count("commit_id").alias("commit_count"),
        long_sum(F.col("additions")).alias("additions"),
        long_sum(F.col("deletions")).alias("deletions"),
        F.bitmap_construct_agg(F.bitmap_bit_position(author)).alias("authors"),
    )


def activity(partials: DataFrame, *by: str) -> DataFrame:
    """Commits, distinct authors and lines per ``by``."""
    ranges = partials.groupBy(*by, "author_range").agg(
        *[F.sum(c).alias(c) for c in _COUNTS], F.bitmap_or_agg("authors").alias("authors")
    )
    distinct = F.sum(F.when(F.col("author_range").isNotNull(), F.bitmap_count("authors")).otherwise(0))
    return ranges.groupBy(*by).agg(
        F.sum("commit_count").alias("commit_count"),
        distinct.alias("unique_authors"),
        F.sum("additions").alias("additions"),
        F.sum("deletions").alias("deletions"),
    )


def commit_timeline(
    partials: DataFrame, calendar: DataFrame, period: str = "weekly", limit: int = 90, repository_id: int | None = None
) -> DataFrame:
    """The commit timeline of ``commits.commit_timeline`` from daily partials."""
    params.one_of("period", period, tuple(times.PERIODS))
    params.between("limit", limit, 7, 365)
    starts = calendar.select("date_id", times.period_start(period, F.col("full_date")).alias("date"))
    dated = params.where_equal(partials, repository_id=repository_id).join(starts, "date_id")
    return params.last_periods(activity(dated, "date"), limit)


def daily_commit_activity(partials: DataFrame, star: Star) -> DataFrame:
    """The view of ``commits.daily_commit_activity`` from daily partials."""
    per_day = activity(partials, "date_id", "repository_id")
    names = star.repo.select("repository_id", F.col("full_name").alias("repository"))
    return (
        per_day.join(star.date, "date_id")
        .join(names, "repository_id")
        .select(
            "full_date", "year", "month", "day_name", "is_weekend", "repository",
            "commit_count", "unique_authors", "additions", "deletions",
        )
        .orderBy("full_date", "repository")
    )
