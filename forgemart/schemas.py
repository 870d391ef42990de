"""Column contracts of every layer, as Spark DDL.

RAW is the REST payload, BRONZE the landed record, SILVER the cleaned table and GOLD the star schema.
Nothing in the library infers a schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

ENTITIES = ("repositories", "commits", "pull_requests", "issues", "contributors", "languages")

_PERSON = "STRUCT<name: STRING, email: STRING, date: STRING>"
_LOGIN = "STRUCT<login: STRING>"

RAW_DDL = {
    "repositories": f"""
        id BIGINT, full_name STRING, name STRING, owner {_LOGIN}, description STRING, language STRING,
        default_branch STRING, private BOOLEAN, fork BOOLEAN, stargazers_count INT, forks_count INT,
        watchers_count INT, open_issues_count INT, size INT, created_at STRING, updated_at STRING,
        pushed_at STRING, topics ARRAY<STRING>, license STRUCT<spdx_id: STRING>, html_url STRING""",
    "commits": f"""
        sha STRING, commit STRUCT<author: {_PERSON}, committer: {_PERSON}, message: STRING>,
        author {_LOGIN}, committer {_LOGIN},
        stats STRUCT<additions: INT, deletions: INT, total: INT>, html_url STRING,
        repository_full_name STRING""",
    "pull_requests": f"""
        id BIGINT, number INT, title STRING, state STRING, user {_LOGIN}, created_at STRING,
        updated_at STRING, closed_at STRING, merged_at STRING, comments INT, review_comments INT,
        commits INT, additions INT, deletions INT, changed_files INT, labels ARRAY<STRUCT<name: STRING>>,
        html_url STRING, draft BOOLEAN, repository_full_name STRING""",
    "issues": f"""
        id BIGINT, number INT, title STRING, state STRING, user {_LOGIN}, created_at STRING,
        updated_at STRING, closed_at STRING, comments INT, labels ARRAY<STRUCT<name: STRING>>,
        assignees ARRAY<{_LOGIN}>, milestone STRUCT<title: STRING>, html_url STRING,
        pull_request STRUCT<url: STRING>, repository_full_name STRING""",
    "contributors": """
        id BIGINT, login STRING, contributions INT, avatar_url STRING, type STRING, html_url STRING,
        repository_full_name STRING""",
    "languages": "languages MAP<STRING, BIGINT>, repository_full_name STRING",
}

BRONZE_DDL = {
    "repositories": """
        id BIGINT, full_name STRING, owner STRING, name STRING, description STRING, language STRING,
        default_branch STRING, is_private BOOLEAN, is_fork BOOLEAN, stars_count INT, forks_count INT,
        watchers_count INT, open_issues_count INT, size_kb INT, created_at STRING, updated_at STRING,
        pushed_at STRING, topics ARRAY<STRING>, license_name STRING, html_url STRING""",
    "commits": """
        sha STRING, repository_full_name STRING, author_login STRING, author_name STRING,
        author_email STRING, author_date STRING, committer_login STRING, committer_name STRING,
        committer_date STRING, message STRING, additions INT, deletions INT, files_changed INT,
        html_url STRING""",
    "pull_requests": """
        id BIGINT, number INT, repository_full_name STRING, title STRING, state STRING,
        author_login STRING, created_at STRING, updated_at STRING, closed_at STRING, merged_at STRING,
        is_merged BOOLEAN, comments_count INT, review_comments_count INT, commits_count INT,
        additions INT, deletions INT, changed_files INT, labels ARRAY<STRING>, html_url STRING,
        draft BOOLEAN""",
    "issues": """
        id BIGINT, number INT, repository_full_name STRING, title STRING, state STRING,
        author_login STRING, created_at STRING, updated_at STRING, closed_at STRING,
        comments_count INT, labels ARRAY<STRING>, assignees ARRAY<STRING>, milestone STRING,
        html_url STRING""",
    "contributors": """
        id BIGINT, login STRING, repository_full_name STRING, contributions INT, avatar_url STRING,
        type STRING, html_url STRING""",
    "languages": "repository_full_name STRING, languages MAP<STRING, BIGINT>, total_bytes BIGINT",
}

SILVER_DDL = {
    "repositories": """
        github_repo_id BIGINT, full_name STRING, owner STRING, name STRING, description STRING,
        language STRING, default_branch STRING, is_private BOOLEAN, is_fork BOOLEAN, stars_count INT,
        forks_count INT, watchers_count INT, open_issues_count INT, size_kb INT, license_name STRING,
        html_url STRING, created_at TIMESTAMP, updated_at TIMESTAMP""",
    "commits": """
        sha STRING, repository_full_name STRING, author_login STRING, author_name STRING,
        author_email STRING, author_date TIMESTAMP, committer_login STRING, committer_name STRING,
        committer_date TIMESTAMP, message STRING, additions INT, deletions INT, files_changed INT""",
    "pull_requests": """
        github_pr_id BIGINT, number INT, repository_full_name STRING, title STRING, state STRING,
        author_login STRING, draft BOOLEAN, is_merged BOOLEAN, comments_count INT,
        review_comments_count INT, commits_count INT, additions INT, deletions INT, changed_files INT,
        created_at TIMESTAMP, updated_at TIMESTAMP, closed_at TIMESTAMP, merged_at TIMESTAMP""",
    "issues": """
        github_issue_id BIGINT, number INT, repository_full_name STRING, title STRING, state STRING,
        author_login STRING, comments_count INT, labels ARRAY<STRING>, assignees ARRAY<STRING>,
        milestone STRING, created_at TIMESTAMP, updated_at TIMESTAMP, closed_at TIMESTAMP""",
    "contributors": """
        github_user_id BIGINT, login STRING, repository_full_name STRING, contributions INT,
        avatar_url STRING, user_type STRING, html_url STRING""",
    "languages": "repository_full_name STRING, languages MAP<STRING, BIGINT>, total_bytes BIGINT",
}

# Silver columns whose bronze name differs.
RENAMES = {
    "repositories": {"github_repo_id": "id"},
    "pull_requests": {"github_pr_id": "id"},
    "issues": {"github_issue_id": "id"},
    "contributors": {"github_user_id": "id", "user_type": "type"},
}

KEYS = {
    "repositories": ["github_repo_id"],
    "commits": ["sha", "repository_full_name"],
    "pull_requests": ["github_pr_id", "repository_full_name"],
    "issues": ["github_issue_id", "repository_full_name"],
    "contributors": ["github_user_id", "repository_full_name"],
    "languages": ["repository_full_name"],
}

# What a missing silver value becomes.
FILLS = {
    "repositories": {
        "stars_count": 0, "forks_count": 0, "watchers_count": 0, "open_issues_count": 0, "size_kb": 0,
    },
    "commits": {"additions": 0, "deletions": 0, "files_changed": 0, "author_name": "Unknown"},
    "pull_requests": {
        "comments_count": 0, "review_comments_count": 0, "commits_count": 0, "additions": 0,
        "deletions": 0, "changed_files": 0, "draft": False, "is_merged": False,
    },
    "issues": {"comments_count": 0},
    "contributors": {"contributions": 0, "user_type": "User"},
    "languages": {},
}

# Column that places a record in time; rows without it are dropped and the rest partitioned by it.
EVENT_TIME = {"commits": "author_date", "pull_requests": "created_at", "issues": "created_at"}

# (hours column, end column): the start is always created_at.
DURATIONS = {
    "pull_requests": ("time_to_merge_hours", "merged_at"),
    "issues": ("time_to_close_hours", "closed_at"),
}

GOLD_DDL = {
    "dim_date": """
        date_id INT, full_date DATE, year INT, quarter INT, month INT, month_name STRING, week INT,
        day_of_month INT, day_of_week INT, day_name STRING, is_weekend BOOLEAN""",
    "dim_repository": "repository_id BIGINT," + SILVER_DDL["repositories"] + ", etl_loaded_at TIMESTAMP",
    "dim_user": """
        user_id BIGINT, github_user_id BIGINT, login STRING, avatar_url STRING, user_type STRING,
        html_url STRING, etl_loaded_at TIMESTAMP""",
    "fact_commits": """
        commit_id BIGINT, sha STRING, repository_id BIGINT, author_id BIGINT, committer_id BIGINT,
        date_id INT, message STRING, additions INT, deletions INT, files_changed INT, net_lines INT,
        authored_at TIMESTAMP""",
    "fact_pull_requests": """
        pr_id BIGINT, github_pr_id BIGINT, number INT, repository_id BIGINT, author_id BIGINT,
        created_date_id INT, merged_date_id INT, closed_date_id INT, title STRING, state STRING,
        is_merged BOOLEAN, is_draft BOOLEAN, comments_count INT, review_comments_count INT,
        commits_count INT, additions INT, deletions INT, changed_files INT, created_at TIMESTAMP,
        merged_at TIMESTAMP, closed_at TIMESTAMP, time_to_merge_hours DOUBLE""",
    "fact_issues": """
        issue_id BIGINT, github_issue_id BIGINT, number INT, repository_id BIGINT, author_id BIGINT,
        created_date_id INT, closed_date_id INT, title STRING, state STRING, comments_count INT,
        labels ARRAY<STRING>, assignees ARRAY<STRING>, milestone STRING, created_at TIMESTAMP,
        closed_at TIMESTAMP, time_to_close_hours DOUBLE""",
    "repo_languages": "id BIGINT, repository_id BIGINT, language STRING, bytes BIGINT, percentage DOUBLE",
}

# What a column left out of a load gets; the other columns get null.
DEFAULTS = {
    "dim_date": {"is_weekend": False},
    "dim_repository": {
        "default_branch": "main", "is_private": False, "is_fork": False, "stars_count": 0, "forks_count": 0,
        "watchers_count": 0, "open_issues_count": 0, "size_kb": 0,
    },
    "dim_user": {"user_type": "User"},
    "fact_commits": {"additions": 0, "deletions": 0, "files_changed": 0},
    "fact_pull_requests": {
        "is_merged": False, "is_draft": False, "comments_count": 0, "review_comments_count": 0,
        "commits_count": 0, "additions": 0, "deletions": 0, "changed_files": 0,
    },
    "fact_issues": {"comments_count": 0},
    "repo_languages": {"bytes": 0, "percentage": 0.0},
}

# Constraints of the star schema, used by the quality checks.
UNIQUE = {
    "dim_date": [["date_id"], ["full_date"]],
    "dim_repository": [["repository_id"], ["github_repo_id"]],
    "dim_user": [["user_id"], ["login"], ["github_user_id"]],
    "fact_commits": [["commit_id"], ["sha", "repository_id"]],
    "fact_pull_requests": [["pr_id"], ["github_pr_id", "repository_id"]],
    "fact_issues": [["issue_id"], ["github_issue_id", "repository_id"]],
    "repo_languages": [["repository_id", "language"]],
}
NOT_NULL = {
    "dim_repository": ["repository_id", "github_repo_id", "full_name", "owner", "name"],
    "dim_user": ["user_id", "login"],
    "fact_commits": ["commit_id", "sha", "repository_id"],
    "fact_pull_requests": ["pr_id", "github_pr_id", "number", "repository_id", "state"],
    "fact_issues": ["issue_id", "github_issue_id", "number", "repository_id", "state"],
    "repo_languages": ["repository_id", "language", "bytes"],
}
MAX_LENGTH = {
    "dim_repository": {
        "full_name": 255, "owner": 100, "name": 200, "language": 50, "default_branch": 100,
        "license_name": 50, "html_url": 500,
    },
    "dim_user": {"login": 100, "avatar_url": 500, "user_type": 20, "html_url": 500},
    "fact_commits": {"sha": 40},
    "fact_pull_requests": {"state": 20},
    "fact_issues": {"state": 20, "milestone": 200},
    "repo_languages": {"language": 50},
}
# Gold tables and the silver tables that their rows are counted by.
GOLD_SOURCES = {
    "dim_repository": "repositories",
    "dim_user": "contributors",
    "fact_commits": "commits",
    "fact_pull_requests": "pull_requests",
    "fact_issues": "issues",
    "repo_languages": "languages",
}
ALLOWED = {
    "fact_pull_requests": {"state": ("open", "closed")},
    "fact_issues": {"state": ("open", "closed")},
}
RUN_STATUSES = ("running", "completed", "failed", "completed_with_errors")
RUN_LOG_DDL = """
    run_id STRING, started_at TIMESTAMP, completed_at TIMESTAMP, status STRING, repos_processed BIGINT,
    total_entities MAP<STRING, BIGINT>, total_commits BIGINT, total_prs BIGINT, total_issues BIGINT,
    errors ARRAY<STRING>"""


def struct(ddl: str) -> T.StructType:
    """DDL as a schema; Spark parses it, so a session must exist."""
    return T.StructType.fromDDL(ddl)


def bronze(entity: str) -> T.StructType:
    return struct(BRONZE_DDL[entity])


def silver(entity: str) -> T.StructType:
    return struct(SILVER_DDL[entity])


def gold(table: str) -> T.StructType:
    return struct(GOLD_DDL[table])
