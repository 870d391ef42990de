"""Raw payloads with absent keys, nulls, blanks and broken text."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forgemart import schemas
from forgemart.plans import bronze


def payloads(spark, *documents):
    texts = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
    return spark.createDataFrame(texts, "payload string")


def normalized(spark, entity, *documents):
    good, _ = bronze.split_corrupt(bronze.parse_payloads(payloads(spark, *documents), entity))
    return [row.asDict(recursive=True) for row in bronze.normalize(entity, good).collect()]


def test_repository_with_everything(spark):
    row, = normalized(spark, "repositories", {
        "id": 1, "full_name": "a/b", "name": "b", "owner": {"login": "a"}, "description": "d", "language": "Go",
        "default_branch": "dev", "private": True, "fork": True, "stargazers_count": 5, "forks_count": 4,
        "watchers_count": 3, "open_issues_count": 2, "size": 9, "created_at": "2024-01-01T00:00:00Z",
        "updated_at": "2024-01-02T00:00:00Z", "pushed_at": "2024-01-03T00:00:00Z", "topics": ["x", "y"],
        "license": {"spdx_id": "MIT"}, "html_url": "u"})
    assert row == {
        "id": 1, "full_name": "a/b", "owner": "a", "name": "b", "description": "d", "language": "Go",
        "default_branch": "dev", "is_private": True, "is_fork": True, "stars_count": 5, "forks_count": 4,
        "watchers_count": 3, "open_issues_count": 2, "size_kb": 9, "created_at": "2024-01-01T00:00:00Z",
        "updated_at": "2024-01-02T00:00:00Z", "pushed_at": "2024-01-03T00:00:00Z", "topics": ["x", "y"],
        "license_name": "MIT", "html_url": "u"}


@pytest.mark.parametrize("extra", [{}, {"license": None, "topics": None, "private": None, "size": None}])
def test_repository_defaults(spark, extra):
    row, = normalized(spark, "repositories", {"id": 1, "full_name": "a/b", "name": "b", "owner": {"login": "a"}, **extra})
    assert (row["default_branch"], row["is_private"], row["size_kb"], row["topics"], row["license_name"]) == (
        "main", False, 0, [], None)
    assert row["created_at"] == "" and row["pushed_at"] is None


def test_commit_without_author_and_stats(spark):
    row, = normalized(spark, "commits", {
        "sha": "s", "commit": {"author": {}, "committer": {"name": "c"}, "message": "m"}, "author": None,
        "stats": None, "repository_full_name": "a/b"})
    assert (row["author_login"], row["author_name"], row["committer_name"], row["author_date"]) == (None, "Unknown", "c", "")
    assert (row["additions"], row["deletions"], row["files_changed"]) == (0, 0, 0)


def test_commit_files_changed_is_the_line_total(spark):
    row, = normalized(spark, "commits", {"sha": "s", "stats": {"additions": 2, "deletions": 3, "total": 5}})
    assert row["files_changed"] == 5


def test_pull_request_is_merged_when_it_has_a_merge_time(spark):
    rows = normalized(
        spark, "pull_requests",
        {"id": 1, "number": 1, "merged_at": "2024-01-01T00:00:00Z", "labels": [{"name": "bug"}, {}]},
        {"id": 2, "number": 2, "merged_at": None, "user": None})
    assert [(r["is_merged"], r["labels"], r["draft"]) for r in rows] == [(True, ["bug", ""], False), (False, [], False)]


def test_issue_feed_leaves_pull_requests_out(spark):
    rows = normalized(
        spark, "issues",
        {"id": 1, "number": 1, "milestone": None, "assignees": [{"login": "x"}, {}]},
        {"id": 2, "number": 2, "milestone": {"title": "v1"}, "pull_request": {"url": "u"}},
        {"id": 3, "number": 3, "milestone": {"title": "v2"}, "pull_request": {}})
    assert [(r["id"], r["milestone"], r["assignees"]) for r in rows] == [(1, None, ["x", ""])]


def test_languages(spark):
    rows = normalized(spark, "languages", {"languages": {"Go": 3, "C": 4}, "repository_full_name": "a/b"},
                      {"languages": {}, "repository_full_name": "a/c"}, {"repository_full_name": "a/d"})
    assert [r["total_bytes"] for r in rows] == [7, 0, 0]


def test_broken_payloads_are_set_aside(spark):
    parsed = bronze.parse_payloads(payloads(spark, {"id": 1, "login": "x"}, "{nope", '{"id": "many"}'), "contributors")
    good, bad = bronze.split_corrupt(parsed)
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r._corrupt_record for r in bad.collect()) == ['{"id": "many"}', "{nope"]


def test_normalised_columns_follow_the_contract(spark):
    for entity in schemas.ENTITIES:
        raw = spark.createDataFrame([], schemas.struct(schemas.RAW_DDL[entity]))
        found = bronze.normalize(entity, raw).schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schemas.bronze(entity)]


def test_allow_list_reports_malformed_names(spark):
    df = spark.createDataFrame([("a/b",), ("a/c",)], "full_name string")
    kept, skipped = bronze.allow_repos(df, [" a/b ", "plain"])
    assert [r.full_name for r in kept.collect()] == ["a/b"] and skipped == ["plain"]


def test_caps(spark):
    rows = [(i, f"o{i % 2}", f"2024-01-{i + 1:02d}") for i in range(10)]
    repos = spark.createDataFrame(rows, "id long, owner string, updated_at string")
    assert sorted(r.id for r in bronze.cap_repos(repos, 2).collect()) == [6, 7, 8, 9]
    with pytest.raises(ValueError):
        bronze.cap_repos(repos, 0)


def test_run_summary_without_errors(spark):
    some = spark.range(3).select(F.col("id").cast("string").alias("sha"))
    none = spark.createDataFrame([], "reason string")
    stamp = F.lit(datetime(2024, 1, 1))
    row, = bronze.run_summary({"commits": some}, "r", stamp, stamp, none).collect()
    assert (row.status, row.total_commits, row.errors, row.total_entities["issues"]) == ("completed", 3, [], 0)


def test_run_log_refuses_unknown_status(spark, tmp_path):
    some = spark.range(1).select(F.lit("r").alias("run_id"), F.lit("lost").alias("status"))
    with pytest.raises(Exception, match="unknown run status"):
        bronze.append_run_log(some, str(tmp_path / "log"))
