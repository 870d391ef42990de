"""Repository overview and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemart.functions.numbers import long_sum
from forgemart.plans import params
from forgemart.plans.star import Star

SORTS = ("stars_count", "forks_count", "total_commits", "name")
_SHOWN = [
    "repository_id", "full_name", "owner", "name", "description", "language", "stars_count", "forks_count",
    "is_fork", "created_at", "html_url",
]
FANNED_OUT = ("total_additions", "total_deletions")
_COUNTS = ["total_commits", "total_prs", "total_issues", "total_additions", "total_deletions"]


def repository_overview(star: Star, compat_fanout: bool = False) -> DataFrame:
    """Per repository its attributes, number of commits, pull requests and issues, and lines changed.

    Each fact is reduced to one row per repository before the join. ``compat_fanout`` gives the line sums of a
    plain three-way join, where every commit repeats once per pull request and issue; they outgrow BIGINT and are
    DECIMAL(38, 0).
    """
    filled = _overview(star.repo, star.commits, star.prs, star.issues)
    if not compat_fanout:
        return filled
    one = F.lit(1).cast("bigint")
    prs, issues = (F.greatest(c, one).cast("decimal(38,0)") for c in ("total_prs", "total_issues"))
    return filled.withColumns({c: F.col(c).cast("decimal(38,0)") * prs * issues for c in FANNED_OUT})


def _overview(repo: DataFrame, commits: DataFrame, prs: DataFrame, issues: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    per_repo = commits.groupBy("repository_id").agg(
        n.alias("total_commits"),
        long_sum(F.col("additions")).alias("total_additions"),
        long_sum(F.col("deletions")).alias("total_deletions"),
    )
    joined = (
        repo.select(*_SHOWN)
        .join(per_repo, "repository_id", "left")
        .join(prs.groupBy("repository_id").agg(n.alias("total_prs")), "repository_id", "left")
        .join(issues.groupBy("repository_id").agg(n.alias("total_issues")), "repository_id", "left")
    )
    return joined.select(
        *_SHOWN, *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in _COUNTS]
    )


def list_repositories(
    star: Star,
    sort_by: str = "stars_count",
    order: str = "desc",
    limit: int = 50,
    offset: int = 0,
    language: str | None = None,
) -> DataFrame:
    """A page of the overview. Nulls sort as the largest value; ties go by ``repository_id``."""
    params.one_of("sort_by", sort_by, SORTS)
    params.one_of("order", order, ("asc", "desc"))
    params.between("limit", limit, 1, 200)
    params.between("offset", offset, 0)
    column = F.col(sort_by)
    ranked = [column.desc_nulls_first() if order == "desc" else column.asc_nulls_last(), F.col("repository_id")]
    repo = params.where_equal(star.repo, language=language or None)
    if sort_by == "total_commits":
        counted = _overview(repo, star.commits, star.prs, star.issues)
        return counted.orderBy(*ranked).offset(offset).limit(limit)
    # Sorting by an attribute needs no facts: pick the page first, then count for its at most 200 repositories.
    page = repo.orderBy(*ranked).offset(offset).limit(limit)
    shown = page.select("repository_id")
    facts = [df.join(shown, "repository_id", "left_semi") for df in (star.commits, star.prs, star.issues)]
    return _overview(page, *facts).orderBy(*ranked)


def count_repositories(star: Star, language: str | None = None) -> DataFrame:
    """Number of repositories under the listing's filter, as ``total_count``."""
    repo = params.where_equal(star.repo, language=language or None)
    return repo.agg(F.count(F.lit(1)).alias("total_count"))


def get_repository(star: Star, repository_id: int) -> DataFrame:
    """The overview of one repository; empty when there is none with that id."""
    frames = (star.repo, star.commits, star.prs, star.issues)
    return _overview(*[params.where_equal(df, repository_id=repository_id) for df in frames])


def unique_languages(star: Star) -> DataFrame:
    return star.repo.filter(F.col("language").isNotNull()).select("language").distinct().orderBy("language")


def page_info(total: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """First and last row shown, total, and whether a previous or a next page exists."""
    n = F.col("total_count")
    return total.select(
        F.lit(offset + 1).cast("bigint").alias("first_row"),
        F.least(F.lit(offset + limit).cast("bigint"), n).alias("last_row"),
        n,
        F.lit(offset > 0).alias("has_previous"),
        (F.lit(offset + limit) < n).alias("has_next"),
    )
