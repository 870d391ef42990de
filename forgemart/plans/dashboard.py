"""Key figures, language mix, and the one-row summary."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemart.functions.numbers import long_sum
from forgemart.plans import commits, issues, params, pulls
from forgemart.plans.star import Star


def core_counts(star: Star) -> DataFrame:
    """One row with the size of every table and the star and fork totals."""
    n = F.count(F.lit(1))
    return star.repo.sparkSession.range(1).select(
        *_base_counts(star),
        star.prs.agg(n).scalar().alias("total_pull_requests"),
        star.issues.agg(n).scalar().alias("total_issues"),
    )


def _base_counts(star: Star) -> list[Column]:
    n = F.count(F.lit(1))
    repo = star.repo.agg(
        n.alias("n"), long_sum(F.col("stars_count")).alias("stars"), long_sum(F.col("forks_count")).alias("forks")
    ).select(F.struct("*")).scalar()
    return [
        repo["n"].alias("total_repositories"),
        star.commits.agg(n).scalar().alias("total_commits"),
        star.user.agg(F.count_distinct("login")).scalar().alias("total_contributors"),
        repo["stars"].alias("total_stars"),
        repo["forks"].alias("total_forks"),
    ]


def _by_bytes(languages: DataFrame) -> DataFrame:
    return languages.groupBy("language").agg(
        long_sum(F.col("bytes")).alias("total_bytes"),
        F.count_distinct("repository_id").alias("repo_count"),
    )


def top_language(star: Star) -> DataFrame:
    """Language with the most bytes; empty when there is none."""
    sizes = star.languages.groupBy("language").agg(F.sum("bytes").alias("total_bytes"))
    return sizes.orderBy(F.col("total_bytes").desc_nulls_first(), "language").limit(1).select("language")


def language_distribution(star: Star, limit: int = 15) -> DataFrame:
    """Languages by bytes: repositories using them and share of the bytes of all languages."""
    params.between("limit", limit, 1)
    shares = commits.share_of_all(_by_bytes(star.languages), "total_bytes", "percentage")
    return shares.orderBy(F.col("total_bytes").desc(), "language").limit(limit)


def _rows(df: DataFrame, *order: Column) -> Column:
    """A frame of bounded length as an array column, sorted by ``order`` and then by all columns."""
    keyed = df.select(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.struct("*").alias("row")).alias("r"))
    ordered = F.transform(F.array_sort(F.collect_list("r")), lambda r: r["row"])
    return keyed.agg(ordered.alias("rows")).scalar()


def dashboard_summary(star: Star, as_of: date | None = None) -> DataFrame:
    """Everything the dashboard shows in one row.

    Each part is aggregated on its own and only then nested: the arrays hold 31 days, 10 contributors and 15
    languages. The parts are scalar subqueries, which Spark plans once each and runs in parallel.
    """
    moment = None if as_of is None else F.lit(as_of)
    pr = pulls.pr_stats(star).select(F.struct("*")).scalar()
    issue = issues.issue_stats(star).select(F.struct("*")).scalar()
    timeline = commits.dense_commit_timeline(star, as_of)
    top = commits.top_contributors(star, limit=10)
    languages = language_distribution(star)
    parts = star.repo.sparkSession.range(1).select(
        *_base_counts(star),
        top_language(star).scalar().alias("top_language"),
        commits.recent_commits(star, moment).scalar().alias("recent_commits_30d"),
        _rows(timeline, F.col("date")).alias("commit_timeline"),
        _rows(top, -F.col("total_commits"), F.col("login")).alias("top_contributors"),
        _rows(languages, -F.col("total_bytes"), F.col("language")).alias("language_distribution"),
        pr.alias("pr_stats"),
        issue.alias("issue_stats"),
    )
    return parts.withColumns(
        {
            "total_pull_requests": F.col("pr_stats.total_prs"),
            "total_issues": F.col("issue_stats.total_issues"),
            "avg_merge_time_hours": F.col("pr_stats.avg_merge_time_hours"),
            "open_issues": F.col("issue_stats.open_issues"),
        }
    )
