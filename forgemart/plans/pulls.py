"""Pull request metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemart.functions import times
from forgemart.functions.numbers import one_place, percent_of
from forgemart.operators.keys import touched_dates
from forgemart.operators.median import grouped_summary
from forgemart.plans import params
from forgemart.plans.star import Star

HOURS = "time_to_merge_hours"


def _summary(prs: DataFrame, keys: list[str]) -> DataFrame:
    """Pull requests by state, mean and median hours to merge."""
    states = {
        "total_prs": F.lit(True),
        "open_prs": F.col("state") == "open",
        "merged_prs": F.col("is_merged"),
        "closed_unmerged": (F.col("state") == "closed") & ~F.col("is_merged"),
    }
    found = grouped_summary(prs, keys, HOURS, states, "mean", "median")
    return found.select(
        *keys, *states,
        one_place(F.col("mean")).alias("avg_merge_time_hours"),
        one_place(F.col("median")).alias("median_merge_time_hours"),
    )


def pr_metrics(star: Star) -> DataFrame:
    """Per repository: pull requests by state, mean and median hours to merge."""
    names = star.repo.select("repository_id", F.col("full_name").alias("repository"))
    placed = star.prs.filter(F.col("repository_id").isNotNull())  # as the join would ask of one branch only
    return _summary(placed, ["repository_id"]).join(names, "repository_id").select(
        "repository", "repository_id", "total_prs", "open_prs", "merged_prs", "closed_unmerged",
        "avg_merge_time_hours", "median_merge_time_hours",
    )


def pr_stats(star: Star, repository_id: int | None = None) -> DataFrame:
    """One row for all pull requests or one repository's: counts by state, hours to merge, merge rate."""
    found = _summary(params.where_equal(star.prs, repository_id=repository_id), [])
    return found.withColumn("merge_rate_pct", percent_of(F.col("merged_prs"), F.col("total_prs")))


def pr_timeline(
    star: Star, period: str = "weekly", limit: int = 52, repository_id: int | None = None
) -> DataFrame:
    """Pull requests opened, merged and closed without merging in the last ``limit`` periods with any event."""
    params.one_of("period", period, tuple(times.PERIODS))
    params.between("limit", limit, 4, 200)
    dates = ["created_date_id", "merged_date_id", "closed_date_id"]
    prs = params.where_equal(star.prs, repository_id=repository_id).select(*dates, "is_merged")
    day = F.col("date_id")
    starts = star.date.select("date_id", times.period_start(period, F.col("full_date")).alias("date"))
    per_period = touched_dates(prs, dates).join(starts, "date_id").groupBy("date").agg(
        F.count_if(F.col("created_date_id") == day).alias("opened"),
        F.count_if(F.col("merged_date_id") == day).alias("merged"),
        F.count_if((F.col("closed_date_id") == day) & ~F.col("is_merged")).alias("closed"),
    )
    return params.last_periods(per_period, limit)


def merge_time_trend(
    star: Star, period: str = "monthly", limit: int = 12, repository_id: int | None = None
) -> DataFrame:
    """Mean and median hours to merge, and merges, in the last ``limit`` periods with merges."""
    params.one_of("period", period, ("weekly", "monthly"))
    params.between("limit", limit, 4, 52)
    merged = (
        params.where_equal(star.prs, repository_id=repository_id)
        .filter("is_merged")
        .select(times.period_start(period, F.col("merged_at")).alias("date"), HOURS)
    )
    found = grouped_summary(merged, ["date"], HOURS, {"merged_count": F.lit(True)}, "mean", "median")
    trend = found.select(
        "date",
        one_place(F.col("mean")).alias("avg_hours"),
        one_place(F.col("median")).alias("median_hours"),
        "merged_count",
    )
    return params.last_periods(trend, limit)


def state_shares(stats: DataFrame, total: str, parts: list[str]) -> DataFrame:
    """Percentage of each state count in the total, 0 for an empty total and never above 100."""
    base = F.greatest(F.col(total), F.lit(1))
    return stats.select(
        *[F.least(F.col(c) / base * 100, F.lit(100.0)).alias(f"{c}_pct") for c in parts]
    )
