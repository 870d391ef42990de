"""A small hand-made star with the awkward rows in it."""

from datetime import date, datetime

from forgemart.plans.star import Star, dim_date


def at(text):
    return datetime.fromisoformat(text)


def small_star(spark):
    repo = spark.createDataFrame(
        [
            (0, 100, "a/zero", "a", "zero", None, "Go", 5, 1, False, at("2020-01-01"), "u0"),
            (1, 101, "a/one", "a", "one", None, None, 7, 1, False, at("2020-01-01"), "u1"),
            (2, 102, "b/two", "b", "two", "empty", "Rust", None, 0, True, None, None),
        ],
        """repository_id long, github_repo_id long, full_name string, owner string, name string, description string,
           language string, stars_count int, forks_count int, is_fork boolean, created_at timestamp, html_url string""",
    )
    user = spark.createDataFrame(
        [(1, "ann", "img"), (2, "bob", None), (3, "idle", None)], "user_id long, login string, avatar_url string"
    )
    commits = spark.createDataFrame(
        [
            (1, 0, 1, 20240101, 10, 1, at("2024-01-01T10:00:00")),
            (2, 0, 2, 20240101, 20, 2, at("2024-01-01T11:00:00")),
            (3, 1, 1, 20240103, 30, 3, at("2024-01-03T10:00:00")),
            (4, 1, 2, 20240103, 5, 0, at("2024-01-03T10:30:00")),
            (5, 1, None, 20240103, 7, 0, at("2024-01-03T23:00:00")),
            (6, 1, 1, 19700101, 9, 9, at("1970-01-01T00:00:00")),  # outside the calendar
        ],
        """commit_id long, repository_id long, author_id long, date_id int, additions int, deletions int,
           authored_at timestamp""",
    )
    prs = spark.createDataFrame(
        [
            (1, 0, 20240101, 20240101, 20240101, "closed", True, at("2024-01-01T00:00:00"), at("2024-01-01T12:00:00"), 12.0),
            (2, 0, 20240101, None, 20240109, "closed", False, at("2024-01-01T00:00:00"), None, None),
            (3, 0, 20240102, None, None, "open", False, at("2024-01-02T00:00:00"), None, None),
            (4, 1, 20240103, 20240102, 20240102, "closed", True, at("2024-01-03T00:00:00"), at("2024-01-02T00:00:00"), -24.0),
        ],
        """pr_id long, repository_id long, created_date_id int, merged_date_id int, closed_date_id int, state string,
           is_merged boolean, created_at timestamp, merged_at timestamp, time_to_merge_hours double""",
    )
    issues = spark.createDataFrame(
        [
            (1, 0, 20240101, 20240102, "closed", ["bug", "ui"], 24.0),
            (2, 0, 20240101, None, "open", ["bug"], None),
            (3, 1, 20240108, None, "open", None, None),
        ],
        """issue_id long, repository_id long, created_date_id int, closed_date_id int, state string,
           labels array<string>, time_to_close_hours double""",
    )
    languages = spark.createDataFrame(
        [(0, "Go", 60), (0, "C", 20), (1, "Go", 20), (1, "Shell", 0)], "repository_id long, language string, bytes long"
    )
    return Star(repo, user, dim_date(spark, date(2020, 1, 1), date(2030, 12, 31)), commits, prs, issues, languages)
