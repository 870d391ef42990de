"""Issue metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemart.functions import times
from forgemart.functions.numbers import one_place
from forgemart.operators.keys import touched_dates
from forgemart.operators.median import grouped_summary
from forgemart.plans import params
from forgemart.plans.star import Star

HOURS = "time_to_close_hours"


def issue_stats(star: Star) -> DataFrame:
    """One row: issues by state, mean and median hours to close."""
    states = {
        "total_issues": F.lit(True),
        "open_issues": F.col("state") == "open",
        "closed_issues": F.col("state") == "closed",
    }
    found = grouped_summary(star.issues, [], HOURS, states, "mean", "median")
    return found.select(
        *states,
        one_place(F.col("mean")).alias("avg_close_time_hours"),
        one_place(F.col("median")).alias("median_close_time_hours"),
    )


def close_rate(stats: DataFrame) -> DataFrame:
    """Closed issues as a whole percentage, 0 when there are no issues."""
    rate = F.floor(F.col("closed_issues") * 100 / F.col("total_issues") + 0.5)
    return stats.select(F.when(F.col("total_issues") > 0, rate).otherwise(0).alias("close_rate_pct"))


def issue_timeline(star: Star, period: str = "weekly", limit: int = 52) -> DataFrame:
    """Issues opened and closed in the last ``limit`` periods with any event."""
    params.one_of("period", period, tuple(times.PERIODS))
    params.between("limit", limit, 4, 200)
    dates = ["created_date_id", "closed_date_id"]
    day = F.col("date_id")
    starts = star.date.select("date_id", times.period_start(period, F.col("full_date")).alias("date"))
    per_period = touched_dates(star.issues.select(*dates), dates).join(starts, "date_id").groupBy("date").agg(
        F.count_if(F.col("created_date_id") == day).alias("opened"),
        F.count_if(F.col("closed_date_id") == day).alias("closed"),
    )
    return params.last_periods(per_period, limit)


def label_distribution(star: Star) -> DataFrame:
    """Issues per label, most used first."""
    labels = star.issues.select(F.explode("labels").alias("label"))
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "label")
