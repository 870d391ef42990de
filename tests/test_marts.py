"""The analytic queries on hand-made rows: edges, orders, parameters."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from forgemart.bindings import AS_OF, bind
from forgemart.checks import marts
from forgemart.plans import commits, dashboard, issues, pulls, repositories
from stars import small_star


@pytest.fixture(scope="module")
def star(spark):
    return small_star(spark)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_overview_counts_and_empty_repository(star):
    found = rows(repositories.repository_overview(star).orderBy("repository_id"), "total_commits", "total_prs",
                 "total_issues", "total_additions", "total_deletions")
    assert found == [(2, 3, 2, 30, 3), (4, 1, 1, 51, 12), (0, 0, 0, 0, 0)]


def test_compatible_sums_equal_the_plain_join(star):
    plain = (
        star.repo.join(star.commits, "repository_id", "left")
        .join(star.prs.select("repository_id", "pr_id"), "repository_id", "left")
        .join(star.issues.select("repository_id", "issue_id"), "repository_id", "left")
        .groupBy("repository_id")
        .agg(F.coalesce(F.sum("additions"), F.lit(0)).alias("a"), F.coalesce(F.sum("deletions"), F.lit(0)).alias("d"))
        .orderBy("repository_id")
    )
    ours = repositories.repository_overview(star, compat_fanout=True).orderBy("repository_id")
    assert rows(ours, "repository_id", "total_additions", "total_deletions") == rows(plain)


def test_compatible_sums_beyond_bigint(star):
    big = 2**60
    many = replace(star, commits=star.commits.withColumn("additions", F.lit(big)), issues=star.issues.crossJoin(
        star.issues.sparkSession.range(50).select(F.col("id").alias("copy"))))
    n = {r.repository_id: r for r in repositories.repository_overview(many).collect()}
    found = {r.repository_id: r.total_additions for r in repositories.repository_overview(many, compat_fanout=True).collect()}
    expected = {k: r.total_commits * big * max(r.total_prs, 1) * max(r.total_issues, 1) for k, r in n.items()}
    assert found == expected and max(expected.values()) > 2**63
    shown = {r.repository_id: r.total_additions for r in marts._fanned_out(many).collect()}
    assert shown == {k: v if v < 2**63 else None for k, v in expected.items()}


@pytest.mark.parametrize("sort_by,order,expected", [
    ("stars_count", "desc", [2, 1, 0]),  # an unknown count sorts as the largest
    ("stars_count", "asc", [0, 1, 2]),
    ("forks_count", "desc", [0, 1, 2]),  # a tie goes by id
    ("total_commits", "desc", [1, 0, 2]),
    ("name", "asc", [1, 2, 0]),
])
def test_listing_order(star, sort_by, order, expected):
    found = repositories.list_repositories(star, sort_by=sort_by, order=order)
    assert [r.repository_id for r in found.collect()] == expected


def test_listing_pages_and_filter(star):
    assert [r.repository_id for r in repositories.list_repositories(star, limit=1, offset=1).collect()] == [1]
    filtered = repositories.list_repositories(star, language="Go").collect()
    assert [(r.repository_id, r.total_commits) for r in filtered] == [(0, 2)]
    assert rows(repositories.count_repositories(star, "Go")) == [(1,)]
    assert rows(repositories.count_repositories(star)) == [(3,)]


def test_repository_zero_is_a_repository(star):
    assert rows(repositories.get_repository(star, 0), "full_name", "total_commits") == [("a/zero", 2)]
    assert rows(commits.total_commits(star, 0)) == [(2,)]
    assert repositories.get_repository(star, 99).isEmpty()


def test_unique_languages(star):
    assert rows(repositories.unique_languages(star)) == [("Go",), ("Rust",)]


@pytest.mark.parametrize("call", [
    lambda s: repositories.list_repositories(s, sort_by="owner; DROP"),
    lambda s: repositories.list_repositories(s, order="down"),
    lambda s: repositories.list_repositories(s, limit=201),
    lambda s: repositories.list_repositories(s, offset=-1),
    lambda s: commits.commit_timeline(s, period="yearly"),
    lambda s: commits.commit_timeline(s, limit=6),
    lambda s: commits.commit_timeline(s, limit=366),
    lambda s: commits.top_contributors(s, limit=101),
    lambda s: pulls.pr_timeline(s, limit=3),
    lambda s: pulls.pr_timeline(s, limit=201),
    lambda s: pulls.merge_time_trend(s, period="daily"),
    lambda s: pulls.merge_time_trend(s, limit=53),
])
def test_bad_parameters_are_refused(star, call):
    with pytest.raises(ValueError):
        call(star)


def test_timeline_drops_days_outside_the_calendar(star):
    assert rows(commits.commit_timeline(star)) == [
        (date(2024, 1, 1), 2, 2, 30, 3), (date(2024, 1, 3), 3, 2, 42, 3)]
    assert rows(commits.commit_timeline(star, "weekly"), "date", "commit_count") == [(date(2024, 1, 1), 5)]


def test_last_periods_are_kept_in_order(spark, sf_dir):
    bound = bind(spark, sf_dir)
    every = rows(commits.commit_timeline(bound, limit=365), "date")
    assert rows(commits.commit_timeline(bound, limit=7), "date") == every[-7:]


def test_timeline_totals_equal_the_fact(spark, sf_dir):
    bound = bind(spark, sf_dir)
    total = commits.commit_timeline(bound, "monthly", 365).agg(F.sum("commit_count")).first()[0]
    assert total == bound.commits.count()


def test_contributors(star):
    assert rows(commits.top_contributors(star), "login", "total_commits", "repos_contributed_to", "total_additions") == [
        ("ann", 3, 2, 49), ("bob", 2, 2, 25)]
    assert rows(commits.top_contributors(star, repository_id=0, limit=1), "login") == [("ann",)]
    shares = rows(commits.contributor_shares(star), "rank", "login", "share_of_top")
    assert [(r, n, round(s, 4)) for r, n, s in shares] == [(1, "ann", 100.0), (2, "bob", 66.6667)]


def test_heatmap_has_monday_first_and_every_cell(star):
    cells = commits.commit_heatmap(star)
    assert rows(cells, "day_of_week", "day_name", "hour", "commit_count") == [
        (0, "Monday", 10, 1), (0, "Monday", 11, 1), (2, "Wednesday", 10, 2), (2, "Wednesday", 23, 1)]
    dense = commits.commit_heatmap(star, dense=True)
    assert dense.count() == 168 and dense.agg(F.sum("commit_count")).first()[0] == 5
    assert commits.commit_heatmap(star, year=2023).isEmpty()


def test_heat_levels(spark):
    counts = [0, 14, 15, 34, 35, 59, 60, 79, 80, 100]
    cells = spark.createDataFrame([(c,) for c in counts], "commit_count long")
    assert [r.level for r in commits.heat_levels(cells).orderBy("commit_count").collect()] == [0, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    empty = spark.createDataFrame([(0,)], "commit_count long")
    assert commits.heat_levels(empty).first().level == 0


def test_dense_timeline_has_every_day(star):
    found = rows(commits.dense_commit_timeline(star, date(2024, 1, 3)))
    assert len(found) == 31 and found[0][0] == date(2023, 12, 4) and found[-1] == (date(2024, 1, 3), 3, 2, 42, 3)
    assert found[-2] == (date(2024, 1, 2), 0, 0, 0, 0)


def test_recent_commits(star):
    assert rows(commits.recent_commits(star, F.lit(datetime(2024, 1, 31, 10, 30)))) == [(4,)]
    assert rows(commits.recent_commits(star, F.lit(datetime(2024, 2, 2, 10, 30)))) == [(2,)]


def test_pr_stats(star):
    assert rows(pulls.pr_stats(star)) == [(4, 1, 2, 1, -6.0, -6.0, 50.0)]
    assert rows(pulls.pr_stats(star, 0)) == [(3, 1, 1, 1, 12.0, 12.0, 33.3)]
    assert rows(pulls.pr_stats(star, 99)) == [(0, 0, 0, 0, None, None, None)]


def test_pr_metrics_leave_out_repositories_without_pull_requests(star):
    assert rows(pulls.pr_metrics(star).orderBy("repository_id"), "repository", "total_prs", "median_merge_time_hours") == [
        ("a/zero", 3, 12.0), ("a/one", 1, -24.0)]


def test_pr_timeline_counts_merged_ones_once_and_not_as_closed(star):
    assert rows(pulls.pr_timeline(star, "daily")) == [
        (date(2024, 1, 1), 2, 1, 0), (date(2024, 1, 2), 1, 1, 0), (date(2024, 1, 3), 1, 0, 0), (date(2024, 1, 9), 0, 0, 1)]


def test_merge_time_trend(star):
    assert rows(pulls.merge_time_trend(star)) == [(date(2024, 1, 1), -6.0, -6.0, 2)]


def test_state_shares(spark):
    stats = spark.createDataFrame([(0, 0)], "total_prs long, open_prs long")
    assert rows(pulls.state_shares(stats, "total_prs", ["open_prs"])) == [(0.0,)]


def test_issue_queries(star):
    assert rows(issues.issue_stats(star)) == [(3, 2, 1, 24.0, 24.0)]
    assert rows(issues.close_rate(issues.issue_stats(star))) == [(33,)]
    assert rows(issues.issue_timeline(star, "weekly")) == [(date(2024, 1, 1), 2, 1), (date(2024, 1, 8), 1, 0)]
    assert rows(issues.label_distribution(star)) == [("bug", 2), ("ui", 1)]


def test_close_rate_without_issues(star):
    none = issues.issue_stats(small_star_without_issues(star))
    assert rows(issues.close_rate(none)) == [(0,)]


def small_star_without_issues(star):
    from dataclasses import replace

    return replace(star, issues=star.issues.limit(0))


def test_language_mix(star):
    assert rows(dashboard.language_distribution(star)) == [("Go", 80, 2, 80.0), ("C", 20, 1, 20.0), ("Shell", 0, 1, 0.0)]
    assert rows(dashboard.language_distribution(star, 1)) == [("Go", 80, 2, 80.0)]
    assert rows(dashboard.top_language(star)) == [("Go",)]


def test_language_shares_sum_to_a_hundred(spark, sf_dir):
    total = dashboard.language_distribution(bind(spark, sf_dir)).agg(F.sum("percentage")).first()[0]
    assert total == pytest.approx(100, abs=1)


def test_summary_on_small_star(star):
    row = dashboard.dashboard_summary(star, date(2024, 1, 3)).first()
    assert (row.total_repositories, row.total_commits, row.total_stars, row.top_language) == (3, 6, 12, "Go")
    assert len(row.commit_timeline) == 31 and [r.login for r in row.top_contributors] == ["ann", "bob"]
    assert row.recent_commits_30d == 5 and row.pr_stats.merge_rate_pct == 50.0 and row.open_issues == 2


def test_summary_of_nothing(star):
    from dataclasses import replace

    empty = replace(star, **{n: getattr(star, n).limit(0) for n in ("repo", "user", "commits", "prs", "issues", "languages")})
    row = dashboard.dashboard_summary(empty, AS_OF).first()
    assert (row.total_commits, row.top_language, row.top_contributors, row.avg_merge_time_hours) == (0, None, [], None)
    assert sum(r.commit_count for r in row.commit_timeline) == 0


def test_page_info(spark):
    total = spark.createDataFrame([(41,)], "total_count long")
    assert rows(repositories.page_info(total, 20, 40)) == [(41, 41, 41, True, False)]
    assert rows(repositories.page_info(total, 20, 0)) == [(1, 20, 41, False, True)]
