"""Normalisation of raw payloads, silver cleaning, and lake round trips."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from forgemart import schemas
from forgemart.bindings import bronze_records, raw_payloads, raw_repositories, silver_commits, table
from forgemart.checks.base import flat, iso, sql
from forgemart.functions import times
from forgemart.operators import dedup, quality
from forgemart.plans import bronze, silver
from forgemart.session import scratch_path
from forgemart.sources import lake


def _normalized(entity):
    def query(spark, sf_dir):
        parsed = bronze.parse_payloads(raw_payloads(spark, sf_dir, entity), entity)
        return flat(bronze.normalize(entity, bronze.split_corrupt(parsed)[0]))

    return query


def _cleaned(entity):
    return lambda spark, sf_dir: flat(silver.clean(entity, bronze_records(spark, sf_dir, entity)))


_ORG = "'org/repo' || ({} % 25) AS repository_full_name"

_N1 = """
    SELECT c_custkey AS id, c_mktsegment || '/' || c_name AS full_name, c_mktsegment AS owner, c_name AS name,
           CASE WHEN c_custkey % 3 <> 0 THEN 'a repository' END AS description, CAST(NULL AS VARCHAR) AS language,
           CASE WHEN c_custkey % 5 <> 0 THEN 'trunk' ELSE 'main' END AS default_branch,
           c_custkey % 2 <> 0 AS is_private, FALSE AS is_fork,
           CAST(CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 1000 ELSE 0 END AS INTEGER) AS stars_count,
           0 AS forks_count, 0 AS watchers_count, 0 AS open_issues_count, c_nationkey AS size_kb,
           '' AS created_at, '' AS updated_at, CAST(NULL AS VARCHAR) AS pushed_at,
           CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment || ',x' ELSE '' END AS topics,
           CASE WHEN c_custkey % 4 <> 0 THEN 'MIT' END AS license_name, '' AS html_url
    FROM customer"""
_N2 = f"""
    SELECT md5(CAST(event_id AS VARCHAR)) AS sha, {_ORG.format('event_id')},
           CASE WHEN event_id % 4 <> 0 THEN CAST(user_id AS VARCHAR) END AS author_login,
           CASE WHEN event_id % 5 <> 0 THEN event_type ELSE 'Unknown' END AS author_name,
           user_id || '@mail.example' AS author_email,
           CASE WHEN event_id % 9 <> 0 THEN {iso('ts')} ELSE '' END AS author_date,
           CAST(NULL AS VARCHAR) AS committer_login,
           CASE WHEN event_id % 7 <> 0 THEN event_type ELSE 'Unknown' END AS committer_name,
           CASE WHEN event_id % 9 <> 0 THEN {iso('ts')} ELSE '' END AS committer_date, props AS message,
           CASE WHEN event_id % 6 <> 0 THEN n ELSE 0 END AS additions,
           CASE WHEN event_id % 6 <> 0 THEN 2 * n ELSE 0 END AS deletions,
           CASE WHEN event_id % 6 <> 0 THEN 3 * n ELSE 0 END AS files_changed, '' AS html_url
    FROM (SELECT *, CAST(floor(value) AS INTEGER) AS n FROM events)"""
_N3 = f"""
    SELECT o_orderkey AS id, CAST(o_orderkey % 1000 AS INTEGER) AS number, {_ORG.format('o_orderkey')},
           o_orderpriority AS title, CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'closed' END AS state,
           CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS author_login,
           {iso('o_orderdate')} AS created_at, '' AS updated_at, CAST(NULL AS VARCHAR) AS closed_at,
           CASE WHEN o_orderstatus = 'F' THEN {iso('ms')} END AS merged_at,
           o_orderstatus = 'F' AND ms IS NOT NULL AS is_merged,
           CAST(CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 50 ELSE 0 END AS INTEGER) AS comments_count,
           0 AS review_comments_count, 0 AS commits_count, 0 AS additions, 0 AS deletions, 0 AS changed_files,
           o_orderpriority || ',' || CASE WHEN o_orderkey % 2 <> 0 THEN o_orderstatus ELSE '' END AS labels,
           '' AS html_url, o_orderkey % 10 = 0 AS draft
    FROM shipped"""
_ISSUE = f"""
    SELECT o_orderkey AS id, CAST(o_orderkey % 1000 AS INTEGER) AS number, {_ORG.format('o_orderkey')},
           o_orderpriority AS title, CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'closed' END AS state,
           CAST(o_custkey AS VARCHAR) AS author_login, {iso('o_orderdate')} AS created_at, '' AS updated_at,
           CAST(NULL AS VARCHAR) AS closed_at, 0 AS comments_count, o_orderpriority AS labels,
           CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS assignees,
           CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS milestone, '' AS html_url
    FROM orders WHERE o_orderkey % 5 <> 0"""
_N5 = """
    SELECT c_custkey AS id, c_name AS login, 'org/repo' || c_nationkey AS repository_full_name,
           CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey ELSE 0 END AS contributions, '' AS avatar_url,
           CASE WHEN c_custkey % 10 = 0 THEN 'Bot' ELSE 'User' END AS type, '' AS html_url
    FROM customer"""
_SIZES = """
    SELECT l_suppkey, p_type, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bytes
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""
_N6 = f"""
    SELECT 'org/repo' || l_suppkey AS repository_full_name,
           string_agg(p_type || '=' || bytes, ',' ORDER BY p_type) AS languages,
           CAST(sum(bytes) AS BIGINT) AS total_bytes
    FROM ({_SIZES}) GROUP BY l_suppkey"""

_C1 = """
    SELECT c_custkey AS github_repo_id, c_mktsegment || '/' || c_name AS full_name, c_mktsegment AS owner,
           c_name AS name, CAST(NULL AS VARCHAR) AS description,
           CASE WHEN c_custkey % 3 <> 0 THEN 'Go' END AS language, 'main' AS default_branch, FALSE AS is_private,
           c_custkey % 2 = 0 AS is_fork,
           CAST(CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 1000 + 2 ELSE 0 END AS INTEGER) AS stars_count,
           c_nationkey AS forks_count, 0 AS watchers_count, 0 AS open_issues_count, 0 AS size_kb,
           CAST(NULL AS VARCHAR) AS license_name, '' AS html_url,
           CASE WHEN c_custkey % 5 <> 0 THEN TIMESTAMP '2021-03-04 05:06:07' END AS created_at,
           TIMESTAMP '2024-02-02' AS updated_at
    FROM customer"""
_C2 = """
    SELECT md5(CAST(event_id AS VARCHAR)) AS sha, 'org/repo' || (event_id % 25) AS repository_full_name,
           CASE WHEN event_id % 4 <> 0 THEN CAST(user_id AS VARCHAR) END AS author_login,
           CASE WHEN event_id % 5 <> 0 THEN event_type ELSE 'Unknown' END AS author_name, '' AS author_email,
           date_trunc('second', ts) AS author_date, CAST(NULL AS VARCHAR) AS committer_login,
           CAST(NULL AS VARCHAR) AS committer_name, CAST(NULL AS TIMESTAMP) AS committer_date,
           CASE WHEN event_id % 17 = 0 THEN 'seen on day 1' ELSE 'seen on day 2' END AS message,
           n AS additions, n AS deletions, n AS files_changed,
           CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month
    FROM (SELECT *, CAST(CASE WHEN event_id % 6 <> 0 THEN floor(value) ELSE 0 END AS INTEGER) AS n FROM events)
    WHERE event_id % 19 <> 0"""
_C3 = """
    SELECT o_orderkey AS github_pr_id, CAST(o_orderkey % 1000 AS INTEGER) AS number,
           'org/repo' || (o_orderkey % 25) AS repository_full_name, o_orderpriority AS title,
           CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'closed' END AS state,
           CAST(o_custkey AS VARCHAR) AS author_login, FALSE AS draft, o_orderstatus = 'F' AS is_merged,
           CAST(o_custkey % 50 AS INTEGER) AS comments_count, 0 AS review_comments_count, 0 AS commits_count,
           0 AS additions, 0 AS deletions, 0 AS changed_files, o_orderdate AS created_at,
           TIMESTAMP '2024-02-02' AS updated_at, CASE WHEN o_orderstatus <> 'O' THEN ms END AS closed_at,
           CASE WHEN o_orderstatus = 'F' THEN ms END AS merged_at,
           CASE WHEN o_orderstatus = 'F' THEN date_diff('second', o_orderdate, ms) / 3600.0 END AS time_to_merge_hours,
           CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
    FROM shipped WHERE o_orderkey % 23 <> 0"""
_C4 = """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY github_issue_id, repository_full_name ORDER BY updated_at DESC,
            number, title, state, author_login, comments_count NULLS FIRST, labels, created_at, closed_at NULLS FIRST) AS rn
        FROM (
            SELECT l_orderkey * 10 + l_linenumber AS github_issue_id, l_linenumber AS number,
                   'org/repo' || (l_orderkey % 25) AS repository_full_name, l_returnflag AS title,
                   CASE l_linestatus WHEN 'O' THEN 'open' ELSE 'closed' END AS state,
                   CAST(l_suppkey AS VARCHAR) AS author_login,
                   CASE WHEN l_suppkey % 3 <> 0 THEN CAST(l_quantity AS INTEGER) END AS comments_count,
                   l_returnflag || ',' || l_linestatus AS labels, CAST(l_suppkey AS VARCHAR) AS assignees,
                   CAST(NULL AS VARCHAR) AS milestone,
                   CAST(CAST(l_shipdate AS DATE) - l_linenumber AS TIMESTAMP) AS created_at, l_shipdate AS updated_at,
                   CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS closed_at
            FROM lineitem WHERE l_partkey % 29 <> 0))
    WHERE rn = 1"""
_C4_FULL = f"""
    SELECT * REPLACE (coalesce(comments_count, 0) AS comments_count),
           date_diff('second', created_at, closed_at) / 3600.0 AS time_to_close_hours,
           CAST(year(created_at) AS INTEGER) AS year, CAST(month(created_at) AS INTEGER) AS month
    FROM ({_C4})"""
_C5 = """
    SELECT c_custkey AS github_user_id, c_name AS login, 'org/repo' || c_nationkey AS repository_full_name,
           CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey + 2 ELSE 0 END AS contributions,
           CAST(NULL AS VARCHAR) AS avatar_url, CASE WHEN c_custkey % 10 = 0 THEN 'Bot' ELSE 'User' END AS user_type,
           CAST(NULL AS VARCHAR) AS html_url
    FROM customer"""
_C6 = f"SELECT * REPLACE (total_bytes + 2 AS total_bytes) FROM ({_N6})"


def _bronze_round_trip(spark, sf_dir):
    """Land a feed, then read it back from its folder."""
    paths = lake.LakePaths(scratch_path(spark, "lake"))
    records = bronze_records(spark, sf_dir, "pull_requests").drop("year", "month", "day")
    lake.write_bronze(records, paths, "pull_requests", date(2024, 2, 3))
    back = lake.read_bronze(spark, paths, "pull_requests", since=date(2024, 2, 3))
    return back.select("id", "repository_full_name", "state", "author_login", "created_at", "merged_at", "day")


def _bronze_pruned(spark, sf_dir):
    """Land two days, read the second only."""
    paths = lake.LakePaths(scratch_path(spark, "lake"))
    records = bronze.normalize(
        "contributors", bronze.parse_payloads(raw_payloads(spark, sf_dir, "contributors"), "contributors")
    )
    lake.write_bronze(records.filter("contributions < 10"), paths, "contributors", date(2024, 1, 31))
    lake.write_bronze(records.filter("contributions >= 10"), paths, "contributors", date(2024, 2, 1))
    return lake.read_bronze(spark, paths, "contributors", since=date(2024, 2, 1)).select("id", "login", "month", "day")


def _silver_round_trip(spark, sf_dir):
    """Write a partitioned silver table and read it back."""
    paths = lake.LakePaths(scratch_path(spark, "lake"))
    cleaned = silver.clean("issues", bronze_records(spark, sf_dir, "issues"))
    lake.write_silver(cleaned, paths, "issues", silver.partition_columns("issues"))
    return lake.read_silver(spark, paths, "issues").select("github_issue_id", "state", "created_at", "year", "month")


def _touched_only(spark, sf_dir):
    """Overwrite the partitions of a later delivery, keep the others."""
    paths = lake.LakePaths(scratch_path(spark, "lake"))
    commits = silver.with_year_month(silver_commits(spark, sf_dir).select("sha", "author_date"), "author_date")
    by_day = commits.withColumn("day", F.dayofmonth("author_date")).drop("year", "month")
    lake.write_silver(by_day, paths, "commits", ["day"])
    later = by_day.filter("day > 20").withColumn("sha", F.concat(F.lit("new-"), "sha"))
    lake.write_silver(later, paths, "commits", ["day"], only_touched=True)
    return lake.read_silver(spark, paths, "commits").select("sha", "day")


def _audited_write(spark, sf_dir):
    """Row counts observed while writing, next to a count of what was written."""
    paths = lake.LakePaths(scratch_path(spark, "lake"))
    seen = lake.write_silver(table(spark, sf_dir, "orders"), paths, "orders")
    stored = lake.read_silver(spark, paths, "orders")
    return stored.agg(F.count(F.lit(1)).alias("n_stored")).withColumn("n_observed", F.lit(seen.get["rows"]).cast("bigint"))


def _all_sources(spark, sf_dir):
    """Entities that were landed are reported, the missing one is skipped."""
    paths = lake.LakePaths(scratch_path(spark, "lake"))
    for entity in schemas.ENTITIES:
        if entity != "issues":
            records = bronze_records(spark, sf_dir, entity).drop("year", "month", "day")
            lake.write_bronze(records, paths, entity, date(2024, 2, 3))
    found = {e: lake.read_bronze(spark, paths, e) for e in schemas.ENTITIES}
    return lake.load_report({name: df for name, df in found.items() if df is not None})


def _isolated_errors(spark, sf_dir):
    """Broken payloads are set aside and counted while the rest goes on."""
    texts_df = raw_payloads(spark, sf_dir, "contributors").withColumn("id", F.get_json_object("payload", "$.id").cast("bigint"))
    broken = texts_df.withColumn(
        "payload",
        F.when(F.col("id") % 50 == 7, F.lit("{not json")).otherwise(F.col("payload")),
    ).select("payload")
    good, bad = bronze.split_corrupt(bronze.parse_payloads(broken, "contributors"))
    records = bronze.normalize("contributors", good)
    return lake.load_report({"accepted": records, "rejected": bad})


def _explicit_nulls(spark, sf_dir):
    """Payloads some of which give their empty keys as null and some leave them out."""
    raw = raw_repositories(spark, sf_dir)
    given = F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"})
    texts_df = raw.select(F.when(F.col("id") % 7 < 3, given).otherwise(F.to_json(F.struct(*raw.columns))).alias("payload"))
    records = bronze.normalize("repositories", bronze.parse_payloads(texts_df, "repositories", exact_nulls=True))
    return flat(records.select("id", "default_branch", "is_private", "stars_count", "watchers_count", "topics", "license_name"))


def _run_log(spark, sf_dir):
    """A run's summary appended to the log and read back."""
    frames = {e: bronze_records(spark, sf_dir, e) for e in schemas.ENTITIES}
    errors = bronze_records(spark, sf_dir, "commits").filter("author_date = 'not a date'").select(
        F.lit("unreadable date").alias("reason")
    )
    path = scratch_path(spark, "run-log")
    stamp = F.lit("2024-02-03 04:05:06")
    bronze.append_run_log(bronze.run_summary(frames, "r1", stamp, stamp, errors), path)
    back = spark.read.schema(schemas.RUN_LOG_DDL).parquet(path)
    return flat(back.drop("started_at", "completed_at"))


def _validated_dates(spark, sf_dir):
    """Rows rejected for impossible or missing values, with every reason."""
    records = bronze_records(spark, sf_dir, "pull_requests")
    typed = silver.typed_select(records, schemas.silver("pull_requests"), schemas.RENAMES["pull_requests"])
    _, rejected = quality.validate(typed, [
        ("no creation date", F.col("created_at").isNull()),
        ("merged before created", F.col("merged_at") < F.col("created_at")),
        ("closed before created", F.col("closed_at") < F.col("created_at")),
    ])
    return flat(rejected.select("github_pr_id", "reasons"))


_VALIDATED = """
    SELECT o_orderkey AS github_pr_id, reasons FROM (
        SELECT o_orderkey, concat_ws(',',
            CASE WHEN o_orderkey % 23 = 0 THEN 'no creation date' END,
            CASE WHEN o_orderkey % 23 <> 0 AND o_orderstatus = 'F' AND d = 2 AND ms < o_orderdate THEN 'merged before created' END,
            CASE WHEN o_orderkey % 23 <> 0 AND o_orderstatus <> 'O' AND ms < o_orderdate THEN 'closed before created' END)
            AS reasons FROM shipped, (VALUES (1), (2)) v(d))
    WHERE reasons <> ''"""

CASES = {
    # Raw payloads to bronze records
    "N1_normalize_repositories": (_normalized("repositories"), _N1),
    "N2_normalize_commits": (_normalized("commits"), _N2),
    "N3_normalize_pull_requests": (_normalized("pull_requests"), sql("shipped", _N3)),
    "N4_normalize_issues": (_normalized("issues"), _ISSUE),
    "N5_normalize_contributors": (_normalized("contributors"), _N5),
    "N6_normalize_languages": (_normalized("languages"), _N6),
    "N7_issues_without_pull_requests": (
        lambda spark, d: bronze.drop_pr_issues(
            bronze.parse_payloads(raw_payloads(spark, d, "issues"), "issues")).select("id", "number"),
        "SELECT o_orderkey AS id, CAST(o_orderkey % 1000 AS INTEGER) AS number FROM orders WHERE o_orderkey % 5 <> 0",
    ),
    "N8_absent_keys_get_defaults": (
        lambda spark, d: _normalized("commits")(spark, d).groupBy("author_name", "committer_name").agg(
            F.count(F.lit(1)).alias("n_rows")),
        f"SELECT author_name, committer_name, count(*) AS n_rows FROM ({_N2}) GROUP BY ALL",
    ),
    "N8_explicit_nulls_stay": (
        _explicit_nulls,
        """SELECT c_custkey AS id, CASE WHEN c_custkey % 5 <> 0 THEN 'trunk' WHEN NOT given THEN 'main' END AS default_branch,
                  CASE WHEN c_custkey % 2 <> 0 THEN TRUE WHEN NOT given THEN FALSE END AS is_private,
                  CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 1000 AS INTEGER) WHEN NOT given THEN 0 END AS stars_count,
                  0 AS watchers_count,
                  CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment || ',x' WHEN NOT given THEN '' END AS topics,
                  CASE WHEN c_custkey % 4 <> 0 THEN 'MIT' END AS license_name
           FROM (SELECT *, c_custkey % 7 < 3 AS given FROM customer)""",
    ),
    "N9_allowed_repositories": (
        lambda spark, d: bronze.allow_repos(
            bronze_records(spark, d, "commits").select(F.col("repository_full_name").alias("full_name"), "sha", "day"),
            ["org/repo3", " org/repo7 ", "malformed"])[0],
        """SELECT 'org/repo' || (event_id % 25) AS full_name, md5(CAST(event_id AS VARCHAR)) AS sha,
                  CAST(d AS INTEGER) AS day
           FROM events, (VALUES (1), (2)) v(d) WHERE event_id % 25 IN (3, 7)""",
    ),
    "N9_malformed_names": (
        lambda spark, d: bronze.malformed_names(table(spark, d, "customer").select(
            "c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.col("c_name")).otherwise(
                F.concat("c_mktsegment", F.lit("/"), "c_name")).alias("full_name"))),
        "SELECT c_custkey, c_name AS full_name FROM customer WHERE c_custkey % 4 = 0",
    ),
    "N10_cap_repositories_per_owner": (
        lambda spark, d: bronze.cap_repos(table(spark, d, "orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("owner"),
            F.col("o_orderdate").alias("updated_at")), 3),
        """SELECT id, owner, updated_at FROM (
               SELECT o_orderkey AS id, o_custkey AS owner, o_orderdate AS updated_at,
                      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
           WHERE rn <= 3""",
    ),
    "N11_cap_commits_per_repository": (
        lambda spark, d: bronze.cap_feed(table(spark, d, "events").select(
            F.col("event_id").cast("string").alias("sha"), F.col("event_type").alias("repository_full_name"),
            F.col("ts").alias("author_date")), "commits", 2),
        """SELECT sha, repository_full_name, author_date FROM (
               SELECT CAST(event_id AS VARCHAR) AS sha, event_type AS repository_full_name, ts AS author_date,
                      row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, CAST(event_id AS VARCHAR)) AS rn
               FROM events) WHERE rn <= 200""",
    ),
    "N11_cap_pull_requests_per_repository": (
        lambda spark, d: bronze.cap_feed(table(spark, d, "orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("repository_full_name"),
            F.col("o_orderdate").alias("updated_at")), "pull_requests", bronze.FEEDS["pull_requests"][2]),
        """SELECT id, repository_full_name, updated_at FROM (
               SELECT o_orderkey AS id, o_orderpriority AS repository_full_name, o_orderdate AS updated_at,
                      row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS rn
               FROM orders) WHERE rn <= 1000""",
    ),
    "N11_large_caps": (
        lambda spark, d: dedup.cap_per_key(
            table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"),
            ["l_returnflag"], [F.col("l_shipdate").desc()], 1500),
        """SELECT * EXCLUDE (rn) FROM (
               SELECT l_returnflag, l_orderkey, l_linenumber, l_shipdate, l_partkey, row_number() OVER (
                   PARTITION BY l_returnflag ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey) AS rn
               FROM lineitem) WHERE rn <= 1500""",
    ),
    "N12_commits_since": (
        lambda spark, d: bronze.since_filter(
            table(spark, d, "events").select("event_id", "ts"), "ts", F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")),
        "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00'",
    ),
    "N13_isolated_errors": (
        _isolated_errors,
        """SELECT 'accepted' AS table_name, count(*) AS n_rows FROM customer WHERE c_custkey % 50 <> 7
           UNION ALL SELECT 'rejected', count(*) FROM customer WHERE c_custkey % 50 = 7""",
    ),
    "N14_run_summary": (
        _run_log,
        """SELECT 'r1' AS run_id, CASE WHEN f > 0 THEN 'completed_with_errors' ELSE 'completed' END AS status,
                  r AS repos_processed, c AS total_commits, p AS total_prs, i AS total_issues,
                  'commits=' || c || ',contributors=' || r || ',issues=' || i || ',languages=' || l || ',pull_requests='
                      || p || ',repositories=' || r AS total_entities, 'unreadable date: ' || f AS errors
           FROM (SELECT 2 * (SELECT count(*) FROM customer) AS r, 2 * (SELECT count(*) FROM events) AS c,
                        2 * (SELECT count(*) FROM orders) AS p, (SELECT count(*) FROM lineitem) AS i,
                        (SELECT 2 * count(DISTINCT l_suppkey) FROM lineitem JOIN part ON l_partkey = p_partkey) AS l,
                        (SELECT 2 * count(*) - count(*) FILTER (WHERE event_id % 17 = 0) FROM events
                         WHERE event_id % 19 = 0) AS f)""",
    ),
    # Cleaning
    "C1_silver_repositories": (_cleaned("repositories"), _C1),
    "C2_silver_commits": (_cleaned("commits"), _C2),
    "C3_silver_pull_requests": (_cleaned("pull_requests"), sql("shipped", _C3)),
    "C4_silver_issues": (_cleaned("issues"), _C4_FULL),
    "C5_silver_contributors": (_cleaned("contributors"), _C5),
    "C6_silver_languages": (_cleaned("languages"), _C6),
    "D1_one_row_per_key": (
        lambda spark, d: dedup.latest_by_key(
            table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()]),
        sql("lines", "SELECT * FROM lines"),
    ),
    "D2_latest_snapshot_wins": (
        lambda spark, d: silver.clean("contributors", bronze_records(spark, d, "contributors")).select(
            "github_user_id", "contributions"),
        f"SELECT github_user_id, contributions FROM ({_C5})",
    ),
    "P1_typed_projection": (
        lambda spark, d: silver.typed_select(
            table(spark, d, "orders").select(
                F.when(F.col("o_orderkey") % 3 == 0, F.lit("many")).otherwise(
                    F.col("o_custkey").cast("string")).alias("contributions"),
                F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("login"),
                F.col("o_orderstatus").alias("repository_full_name"), F.lit("").alias("avatar_url"),
                F.lit("Bot").alias("type"), F.lit("").alias("html_url")),
            schemas.silver("contributors"), schemas.RENAMES["contributors"]),
        """SELECT o_orderkey AS github_user_id, o_orderpriority AS login, o_orderstatus AS repository_full_name,
                  CAST(CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS INTEGER) AS contributions,
                  '' AS avatar_url, 'Bot' AS user_type, '' AS html_url FROM orders""",
    ),
    "P2_text_to_time": (
        lambda spark, d: table(spark, d, "orders").select("o_orderkey", times.parse_time(
            F.when(F.col("o_orderkey") % 5 == 0, F.lit("")).when(F.col("o_orderkey") % 7 == 0, F.lit("soon"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))).alias("parsed")),
        """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN o_orderdate END AS parsed
           FROM orders""",
    ),
    "P3_fill_nulls": (
        lambda spark, d: silver.fill_defaults(bronze_records(spark, d, "contributors").select(
            "id", "day", "contributions", F.col("type").alias("user_type")), "contributors"),
        """SELECT c_custkey AS id, CAST(d AS INTEGER) AS day,
                  CAST(CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey + d ELSE 0 END AS INTEGER) AS contributions,
                  CASE WHEN c_custkey % 10 = 0 THEN 'Bot' ELSE 'User' END AS user_type
           FROM customer, (VALUES (1), (2)) v(d)""",
    ),
    "P4_partition_columns": (
        lambda spark, d: silver.with_year_month(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate"),
        """SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year,
                  CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
    ),
    "P5_undated_rows_dropped": (
        lambda spark, d: silver.require_time(table(spark, d, "lineitem").select(
            "l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 29 != 0, F.col("l_shipdate")).alias("created_at")),
            "created_at"),
        """SELECT l_orderkey, l_linenumber, l_shipdate AS created_at FROM lineitem WHERE l_partkey % 29 <> 0""",
    ),
    "P6_duration_in_hours": (
        lambda spark, d: silver.with_duration(
            silver_commits(spark, d).select("sha", F.col("author_date").alias("created_at"),
                F.when(F.col("additions") > 500, F.col("author_date") + F.expr("INTERVAL '90' MINUTE")).alias("end_at")),
            "hours", "end_at").select("sha", "hours"),
        """SELECT md5(CAST(event_id AS VARCHAR)) AS sha,
                  CASE WHEN CAST(floor(value * 10) AS INTEGER) > 500 THEN CAST(1.5 AS DOUBLE) END AS hours FROM events""",
    ),
    "E3_validation": (_validated_dates, sql("shipped", _VALIDATED)),
    # Lake
    "S1_read_bronze": (
        _bronze_round_trip,
        sql("shipped", f"""
            SELECT o_orderkey AS id, 'org/repo' || (o_orderkey % 25) AS repository_full_name,
                   CASE WHEN d = 1 OR o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS state,
                   CAST(o_custkey AS VARCHAR) AS author_login,
                   CASE WHEN o_orderkey % 23 <> 0 THEN {iso('o_orderdate')} END AS created_at,
                   CASE WHEN o_orderstatus = 'F' AND d = 2 THEN {iso('ms')} END AS merged_at, 3 AS day
            FROM shipped, (VALUES (1), (2)) v(d)"""),
    ),
    "S2_partition_pruned_bronze": (
        _bronze_pruned,
        f"SELECT id, login, 2 AS month, 1 AS day FROM ({_N5}) WHERE contributions >= 10",
    ),
    "S3_optional_sources": (
        _all_sources,
        """SELECT 'contributors' AS table_name, 2 * count(*) AS n_rows FROM customer
           UNION ALL SELECT 'repositories', 2 * count(*) FROM customer
           UNION ALL SELECT 'commits', 2 * count(*) FROM events
           UNION ALL SELECT 'pull_requests', 2 * count(*) FROM orders
           UNION ALL SELECT 'languages', 2 * count(DISTINCT l_suppkey) FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ),
    "S4_S5_silver_round_trip": (
        _silver_round_trip,
        f"SELECT github_issue_id, state, created_at, year, month FROM ({_C4_FULL})",
    ),
    "S4_only_touched_partitions": (
        _touched_only,
        """SELECT CASE WHEN day(ts) > 20 THEN 'new-' ELSE '' END || md5(CAST(event_id AS VARCHAR)) AS sha,
                  CAST(day(ts) AS INTEGER) AS day FROM events""",
    ),
    "S8_landed_files": (
        lambda spark, d: _bronze_round_trip(spark, d).groupBy("day", "state").agg(F.count(F.lit(1)).alias("n_rows")),
        """SELECT 3 AS day, CASE WHEN d = 1 OR o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS state,
                  count(*) AS n_rows FROM orders, (VALUES (1), (2)) v(d) GROUP BY ALL""",
    ),
    "S9_observed_row_counts": (
        _audited_write, "SELECT count(*) AS n_stored, count(*) AS n_observed FROM orders",
    ),
}
