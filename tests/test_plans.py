"""What reaches the scans of a stored star, and how often they run."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from forgemart.bindings import silver_tables
from forgemart.plans import commits, pulls, repositories
from forgemart.sources import gold, lake


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    paths = lake.LakePaths(str(tmp_path_factory.mktemp("lake")))
    return gold.load_star(spark, silver_tables(spark, sf_dir), paths, "1", start=date(1995, 1, 1), part_cols=["year"])


def scans(df, table):
    """Scans of a table's rows; the manifest of a versioned table, a row per partition, is not one of them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [line for line in plan.splitlines() if "FileScan" in line and f"/{table}" in line]
    return [line for line in found if "n_rows" not in line]


def pushed(df, table):
    scan, = scans(df, table)
    return scan[scan.index("PushedFilters"):scan.index("ReadSchema")]


def read_columns(df, table):
    scan, = scans(df, table)
    fields = scan[scan.index("FileScan parquet [") + 18:]
    return {c.split("#")[0] for c in fields[:fields.index("]")].split(",")}


def test_repository_filter_reaches_every_fact(stored):
    df = repositories.get_repository(stored, 3)
    for table in ("fact_commits", "fact_pull_requests", "fact_issues", "dim_repository"):
        assert "EqualTo(repository_id,3)" in pushed(df, table)


def test_date_ranges_reach_the_fact(stored):
    dense = commits.dense_commit_timeline(stored, date(2024, 1, 30))
    assert "GreaterThanOrEqual(date_id,20231231)" in pushed(dense, "fact_commits")
    assert "GreaterThanOrEqual(date_id,20240000)" in pushed(commits.commit_heatmap(stored, year=2024), "fact_commits")
    recent = commits.recent_commits(stored, F.lit(datetime(2024, 1, 30)))
    assert "GreaterThanOrEqual(authored_at" in pushed(recent, "fact_commits")


def test_only_needed_columns_are_read(stored):
    assert read_columns(commits.commit_heatmap(stored), "fact_commits") <= {"date_id", "authored_at", "year", "version"}
    timeline = pulls.pr_timeline(stored)
    assert read_columns(timeline, "fact_pull_requests") <= {
        "created_date_id", "merged_date_id", "closed_date_id", "is_merged", "year", "version"}


def test_overview_scans_each_table_once(stored):
    df = repositories.repository_overview(stored)
    for table in ("fact_commits", "fact_pull_requests", "fact_issues", "dim_repository"):
        assert len(scans(df, table)) == 1


def test_calendar_is_joined_where_the_fact_lies(stored):
    """The small side is broadcast because Spark finds it small; the fact is not shuffled for it."""
    plan = commits.commit_timeline(stored)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
