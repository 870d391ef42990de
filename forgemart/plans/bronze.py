"""Raw API payloads to flat bronze records, and what the ingestion does around them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemart import schemas
from forgemart.functions import numbers, texts
from forgemart.operators import dedup

# Records on a page of a feed; per feed the column it is sorted by, latest or largest first, a key
# for ties, and the pages that are taken.
ROWS_PER_PAGE = 100
FEEDS = {
    "commits": ("author_date", "sha", 5),
    "pull_requests": ("updated_at", "id", 10),
    "issues": ("updated_at", "id", 10),
    "contributors": ("contributions", "login", 5),
}


NULLS = "_null_keys"


def parse_payloads(
    texts_df: DataFrame, entity: str, column: str = "payload", exact_nulls: bool = False
) -> DataFrame:
    """JSON text to typed payload columns; text that does not fit the schema is kept in ``_corrupt_record``.

    ``exact_nulls`` also parses the text as a VARIANT, which tells a key that is there with a null from one that is
    absent, and notes the former in ``_null_keys``: ``normalize`` then gives only absent keys their default.

    The parsed payload goes through a generator: conditions on it are not pushed below, which would parse every
    text once more.
    """
    schema = schemas.struct(schemas.RAW_DDL[entity] + ", _corrupt_record STRING")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    others = [c for c in texts_df.columns if c != column]
    if exact_nulls:
        texts_df = texts_df.withColumn("_variant", F.try_parse_json(column))
        given = [
            F.when(F.is_variant_null(F.try_variant_get("_variant", f"$.{key}", "variant")), F.lit(key))
            for key in _defaulted(entity)
        ]
        texts_df = texts_df.withColumn(NULLS, F.array_compact(F.array(*given)))
        others.append(NULLS)
    payload = F.from_json(F.col(column), schema, options)
    return texts_df.select(*others, F.inline(F.array(payload)))


def _value(default: object) -> Column:
    return F.array().cast("array<string>") if isinstance(default, list) else F.lit(default)


def _or_default(key: str, default: object) -> Column:
    return F.coalesce(F.col(key), _value(default))


def _or_default_if_absent(key: str, default: object) -> Column:
    return F.coalesce(F.col(key), F.when(~F.array_contains(NULLS, key), _value(default)))


def _defaulted(entity: str) -> list[str]:
    """The payload keys of an entity that have a default."""
    keys: list[str] = []
    _MAPPED[entity](lambda key, default: keys.append(key) or F.lit(None))
    return keys


def names_of(items: str, field: str) -> Column:
    """One text per element; a missing array becomes an empty one and a missing text ''."""
    empty = F.array().cast("array<string>")
    return F.coalesce(F.transform(items, lambda item: F.coalesce(item[field], F.lit(""))), empty)


# Per entity, bronze columns that are not a plain copy of the payload field of the same name. ``_or`` says what a key
# without a value becomes.
_MAPPED = {
    "repositories": lambda _or: {
        "owner": F.col("owner.login"),
        "default_branch": _or("default_branch", "main"),
        "is_private": _or("private", False),
        "is_fork": _or("fork", False),
        "stars_count": _or("stargazers_count", 0),
        "forks_count": _or("forks_count", 0),
        "watchers_count": _or("watchers_count", 0),
        "open_issues_count": _or("open_issues_count", 0),
        "size_kb": _or("size", 0),
        "created_at": _or("created_at", ""),
        "updated_at": _or("updated_at", ""),
        "topics": _or("topics", []),
        "license_name": F.col("license.spdx_id"),
        "html_url": _or("html_url", ""),
    },
    "commits": lambda _or: {
        "author_login": F.col("author.login"),
        "author_name": _or("commit.author.name", "Unknown"),
        "author_email": _or("commit.author.email", ""),
        "author_date": _or("commit.author.date", ""),
        "committer_login": F.col("committer.login"),
        "committer_name": _or("commit.committer.name", "Unknown"),
        "committer_date": _or("commit.committer.date", ""),
        "message": _or("commit.message", ""),
        "additions": _or("stats.additions", 0),
        "deletions": _or("stats.deletions", 0),
        # The payload's total is a line total, not a file count; the column keeps the name users know.
        "files_changed": _or("stats.total", 0),
        "html_url": _or("html_url", ""),
    },
    "pull_requests": lambda _or: {
        "title": _or("title", ""),
        "state": _or("state", ""),
        "author_login": F.col("user.login"),
        "created_at": _or("created_at", ""),
        "updated_at": _or("updated_at", ""),
        "is_merged": F.col("merged_at").isNotNull(),
        "comments_count": _or("comments", 0),
        "review_comments_count": _or("review_comments", 0),
        "commits_count": _or("commits", 0),
        "additions": _or("additions", 0),
        "deletions": _or("deletions", 0),
        "changed_files": _or("changed_files", 0),
        "labels": names_of("labels", "name"),
        "html_url": _or("html_url", ""),
        "draft": _or("draft", False),
    },
    "issues": lambda _or: {
        "title": _or("title", ""),
        "state": _or("state", ""),
        "author_login": F.col("user.login"),
        "created_at": _or("created_at", ""),
        "updated_at": _or("updated_at", ""),
        "comments_count": _or("comments", 0),
        "labels": names_of("labels", "name"),
        "assignees": names_of("assignees", "login"),
        "milestone": F.col("milestone.title"),
        "html_url": _or("html_url", ""),
    },
    "contributors": lambda _or: {
        "contributions": _or("contributions", 0),
        "avatar_url": _or("avatar_url", ""),
        "type": _or("type", "User"),
        "html_url": _or("html_url", ""),
    },
    "languages": lambda _or: {"total_bytes": numbers.map_total(F.col("languages"))},
}


def normalize(entity: str, raw: DataFrame) -> DataFrame:
    """Typed payload columns to bronze records; pull requests in the issue feed are left out.

    A null gets the default as an absent key does, unless the payloads were parsed with ``exact_nulls``.
    """
    if entity == "issues":
        raw = drop_pr_issues(raw)
    mapped = _MAPPED[entity](_or_default_if_absent if NULLS in raw.columns else _or_default)
    return raw.select(
        *[mapped.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schemas.bronze(entity)]
    )


def drop_pr_issues(raw: DataFrame) -> DataFrame:
    """The issue feed without the entries that are pull requests."""
    return raw.filter(F.col("pull_request").isNull())


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable records, and the others with their texts.

    Spark refuses to read nothing but the text column from JSON files, so store the second frame before
    counting it.
    """
    bad = F.col("_corrupt_record").isNotNull()
    return df.filter(~bad).drop("_corrupt_record"), df.filter(bad)


def allow_repos(df: DataFrame, names: Sequence[str], column: str = "full_name") -> tuple[DataFrame, list[str]]:
    """Rows of the named ``owner/repo`` repositories, and the names skipped as malformed."""
    cleaned = [name.strip() for name in names]
    wanted = [name for name in cleaned if "/" in name]
    return df.filter(F.col(column).isin(wanted)), [name for name in cleaned if "/" not in name]


def malformed_names(df: DataFrame, column: str = "full_name") -> DataFrame:
    """Rows whose repository name is not of the form ``owner/repo``."""
    return df.filter(F.col(column).isNull() | texts.repo_of(F.col(column)).isNull())


def cap_repos(repos: DataFrame, n: int) -> DataFrame:
    """Per owner the ``n`` most recently updated repositories."""
    return dedup.cap_per_key(repos, ["owner"], [F.col("updated_at").desc_nulls_last(), F.col("id")], n)


def cap_feed(records: DataFrame, entity: str, pages: int) -> DataFrame:
    """Per repository the first ``pages`` of an entity's feed, in the order of the feed; ties go by its key.

    ``FEEDS`` has the usual number of pages; ``rows_over`` tells what a cap leaves out.
    """
    sorted_by, key, _ = FEEDS[entity]
    order = [F.col(sorted_by).desc_nulls_last(), F.col(key)]
    return dedup.cap_per_key(records, ["repository_full_name"], order, pages * ROWS_PER_PAGE)


def rows_over(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows that a cap of ``n`` per key leaves out, for the keys that have more."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > n).select(key, (F.col("n_rows") - n).alias("n_left_out"))


def since_filter(df: DataFrame, column: str, moment: datetime | Column) -> DataFrame:
    """Rows at or after a moment."""
    return df.filter(F.col(column) >= (moment if isinstance(moment, Column) else F.lit(moment)))


def run_summary(
    frames: Mapping[str, DataFrame], run_id: str, started: Column, completed: Column, errors: DataFrame
) -> DataFrame:
    """One run-log row: records per entity, repositories processed, outcome and error reasons.

    ``errors`` has one row per failure with its ``reason``. The row keeps each distinct reason with its count,
    so it stays small however many records fail; the failed records themselves belong in a reject table.
    """
    def rows(entity: str) -> Column:
        if entity not in frames:
            return F.lit(0).cast("bigint")
        return frames[entity].agg(F.count(F.lit(1))).scalar()

    reasons = errors.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    lines = F.array_sort(F.collect_list(F.concat("reason", F.lit(": "), F.col("n").cast("string"))))
    failures = reasons.agg(lines.alias("errors")).scalar()
    spark = errors.sparkSession
    counts = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        started.cast("timestamp").alias("started_at"),
        completed.cast("timestamp").alias("completed_at"),
        failures.alias("errors"),
        *[rows(entity).alias(entity) for entity in schemas.ENTITIES],
    )
    totals = F.map_from_arrays(
        F.array(*[F.lit(e) for e in schemas.ENTITIES]), F.array(*[F.col(e) for e in schemas.ENTITIES])
    )
    status = F.when(F.size("errors") == 0, "completed").otherwise("completed_with_errors")
    return counts.select(
        "run_id",
        "started_at",
        "completed_at",
        status.alias("status"),
        F.col("repositories").alias("repos_processed"),
        totals.alias("total_entities"),
        F.col("commits").alias("total_commits"),
        F.col("pull_requests").alias("total_prs"),
        F.col("issues").alias("total_issues"),
        "errors",
    )


def append_run_log(summary: DataFrame, path: str) -> None:
    """Add a run to the run log; statuses outside the allowed set are refused."""
    checked = summary.withColumn(
        "status",
        F.when(F.col("status").isin(*schemas.RUN_STATUSES), F.col("status")).otherwise(
            F.raise_error(F.concat(F.lit("unknown run status "), F.col("status")))
        ),
    )
    checked.write.mode("append").parquet(path)
