"""Building the star schema, its quality checks, and incremental loads."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemart import bindings, jobs, schemas
from forgemart.bindings import bind, bronze_records, table
from forgemart.checks.base import flat, sql
from forgemart.checks.layers import _C1
from forgemart.operators import incremental, keys, quality
from forgemart.plans import bronze, silver, star
from forgemart.session import scratch_path
from forgemart.sources import gold, lake, versions


def _dims(spark, d):
    return bindings.repositories(spark, d), bindings.users(spark, d)


def _user_sources(spark, d):
    """Contributors, and the authors of commits, some of whom are contributors too."""
    contributors = silver.clean("contributors", bronze_records(spark, d, "contributors"))
    return [star.contributor_users(contributors), star.author_users(bindings.silver_commits(spark, d))]


_USERS = """
    SELECT c_custkey AS github_user_id, c_name AS login, CAST(NULL AS VARCHAR) AS avatar_url,
           CASE WHEN c_custkey % 10 = 0 THEN 'Bot' ELSE 'User' END AS user_type, CAST(NULL AS VARCHAR) AS html_url
    FROM customer
    UNION ALL
    SELECT DISTINCT NULL, author_login, NULL, 'User', NULL FROM sc
    WHERE author_login IS NOT NULL AND author_login NOT IN (SELECT c_name FROM customer)"""

_COMMIT_KEYS = """
    SELECT sha, r.repository_id, u.user_id AS author_id, c.user_id AS committer_id,
           CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_id, event_type AS message,
           CAST(floor(value * 10) AS INTEGER) AS additions, CAST(floor(value) AS INTEGER) AS deletions,
           1 AS files_changed, CAST(floor(value * 10) - floor(value) AS INTEGER) AS net_lines, ts AS authored_at
    FROM sc LEFT JOIN repo r ON r.full_name = repository_full_name
    LEFT JOIN usr u ON u.login = author_login LEFT JOIN usr c ON c.login = committer_login"""


def _key_census(df, key):
    """Rows, distinct keys and smallest key of a numbered frame."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"), (F.min(key) > 0).alias("positive")
    )


def _numbered_users(spark, d):
    return _key_census(star.dim_user(_user_sources(spark, d)), "user_id")


def _kept_keys(spark, d):
    """Keys of a first load that a second, larger one must keep, and whether all keys stay distinct."""
    users = bindings.users(spark, d).drop("user_id")
    first = keys.numbered(users.filter(F.col("login") < "Customer#000000700"), "login", "user_id")
    second = keys.with_kept_keys(first, users, "login", "user_id")
    before = first.select("login", F.col("user_id").alias("before"))
    return second.join(before, "login", "left").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("user_id").alias("n_keys"),
        F.count_if(F.col("user_id") == F.col("before")).alias("n_kept"),
    )


def _orphans(spark, d):
    repo, _ = _dims(spark, d)
    placed = keys.lookup(
        bindings.silver_commits(spark, d).select("sha", "repository_full_name"),
        repo, "full_name", "repository_full_name", "repository_id", "repository_id",
    )
    return placed.filter("repository_id IS NULL").select("sha", "repository_full_name")


def _quality_report(spark, d):
    """Number of rows that break each constraint of the commit fact."""
    repo, user = _dims(spark, d)
    facts = star.fact_commits(bindings.silver_commits(spark, d), repo, user)
    nulls = quality.null_counts(facts, [*schemas.NOT_NULL["fact_commits"], "author_id", "committer_id"])
    return nulls


def _states_outside(spark, d):
    states = bindings.pull_requests(spark, d).withColumn(
        "state", F.when(F.col("pr_id") % 31 == 0, "draft").otherwise(F.col("state")))
    return quality.not_in_set(states, "state", ["open", "closed"]).select("pr_id", "state")


def _orders_split(spark, d):
    """Orders as stored, and a delta that changes some and adds others."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    stored = orders.filter("o_orderstatus <> 'O'")
    delta = orders.filter("o_orderstatus = 'O' OR o_orderpriority = '1-URGENT'").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1)
    return stored, delta


_UPSERTED = """
    SELECT o_orderkey, o_orderstatus, o_orderpriority,
           CASE WHEN o_orderstatus = 'O' OR o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END
               AS o_totalprice
    FROM orders"""


def _upserted_table(spark, d):
    """A partitioned table after a delta that moves some rows to another partition."""
    paths = lake.LakePaths(scratch_path(spark, "lake"))
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    lake.write_silver(orders, paths, "orders", ["year", "month"])
    delta = orders.filter("year = 1997 AND o_orderpriority = '2-HIGH'").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "month": F.lit(12)})
    lake.upsert_silver(spark, paths, "orders", delta, ["o_orderkey"], ["year", "month"])
    return lake.read_silver(spark, paths, "orders")


def _interrupted_upsert(spark, d):
    """What readers see of a table after an upsert that stopped when its data were written, and once it is repeated.

    A reader who opened the table before that keeps the rows it opened.
    """
    path, key, parts = scratch_path(spark, "versions"), ["o_orderkey"], ["year", "month"]
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    versions.replace(spark, path, orders, parts)
    delta = lake.staged(spark, orders.filter("year = 1997 AND o_orderpriority = '2-HIGH'").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "month": F.lit(12)}), "delta").frame
    opened = versions.read(spark, path, orders.schema)
    versions.prepare_merge(spark, path, delta.withColumn("o_totalprice", F.lit(-1.0)), key, parts)  # never published
    during = versions.read(spark, path, orders.schema)
    versions.merge(spark, path, delta, key, parts)
    after = versions.read(spark, path, orders.schema)
    seen = {"opened": opened, "during": during, "after": after}
    return reduce(DataFrame.unionByName, [rows.withColumn("seen", F.lit(name)) for name, rows in seen.items()])


def _incremental(spark, d):
    """Commits not loaded yet: per repository those from its mark on, and all of unknown repositories."""
    events = table(spark, d, "events").select("event_id", (F.col("event_id") % 25).alias("repo"), "ts")
    loaded = events.filter("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00' AND repo <> 4")
    marks = incremental.high_water_mark(loaded, "repo", "ts")
    return incremental.incremental_filter(events, marks, "repo", "ts")


def _silver_layers(spark, d):
    return {e: silver.clean(e, bronze_records(spark, d, e)) for e in schemas.ENTITIES}


def _star_counts(spark, d):
    """Rows per table of a star built from the silver layer; fact rows must neither vanish nor double."""
    built = star.build_star(spark, _silver_layers(spark, d))
    facts = {n: t for n, t in built.tables().items() if n != "dim_date"}
    return lake.load_report(facts)


def stored_silver(spark, d):
    """The silver tables as a load finds them: stored, so that its passes over them don't make them again."""
    return {e: lake.staged(spark, df, e).frame for e, df in bindings.silver_tables(spark, d).items()}


def _star_loaded_again(spark, d):
    """Rows and resolved authors per stored table after a load with some of the users and another with all."""
    paths = lake.LakePaths(scratch_path(spark, "lake"))
    layers = stored_silver(spark, d)
    some = {**layers, "contributors": layers["contributors"].filter("avatar_url IS NOT NULL")}
    gold.load_star(spark, some, paths, "1", part_cols=["year"])
    stored = gold.load_star(spark, layers, paths, "2", previous_id="1", part_cols=["year"])
    rejected = lake.read_table(spark, f"{paths.gold('rejected_fact_commits')}/load=2")
    tables = {n: t for n, t in stored.tables().items() if n != "dim_date"}
    authored = {f"{n}_authors": tables[n].filter("author_id IS NOT NULL") for n in tables if n.startswith("fact_")}
    return lake.load_report({**tables, **authored, "rejected_commits": rejected})


def _resolved(name, key, frame):
    known = f"FROM {frame} WHERE {key} % 97 <> 0"
    # Pull requests and issues by people who neither commit nor contribute have no author.
    return f"""
        UNION ALL SELECT '{name}', (SELECT count(*) {known})
        UNION ALL SELECT '{name}_authors', (SELECT count(*) {known} AND author_login IN (SELECT login FROM everyone))"""


def _job(spark, d):
    """Rows per silver table after landing every record on its day and running the job over the folder."""
    paths = lake.LakePaths(scratch_path(spark, "lake"))
    for entity in schemas.ENTITIES:
        records = bronze_records(spark, d, entity)
        if entity in ("pull_requests", "languages"):  # made by joins; every day reads them
            records = lake.staged(spark, records, entity).frame
        if "day" not in records.columns:
            lake.write_bronze(records, paths, entity, date(2024, 2, 1))
            continue
        for day in (1, 2):
            landed = records.filter(F.col("day") == day).drop("year", "month", "day")
            lake.write_bronze(landed, paths, entity, date(2024, 2, day))
    counts = jobs.bronze_to_silver(spark, paths)
    stored = lake.load_report({e: lake.read_silver(spark, paths, e) for e in schemas.ENTITIES})
    reported = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])
    return stored.withColumn("n_reported", reported[F.col("table_name")].cast("bigint"))


_JOB_COUNTS = """
    SELECT *, n_rows AS n_reported FROM (
        SELECT 'repositories' AS table_name, count(*) AS n_rows FROM customer
        UNION ALL SELECT 'contributors', count(*) FROM customer
        UNION ALL SELECT 'commits', count(*) FROM events WHERE event_id % 19 <> 0
        UNION ALL SELECT 'pull_requests', count(*) FROM orders WHERE o_orderkey % 23 <> 0
        UNION ALL SELECT 'issues', count(*) FROM (
            SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey % 29 <> 0)
        UNION ALL SELECT 'languages', count(DISTINCT l_suppkey) FROM lineitem JOIN part ON l_partkey = p_partkey)"""


_LOADED_COUNTS = f"""
    , everyone AS (SELECT login FROM usr UNION SELECT author_login FROM sc WHERE author_login IS NOT NULL)
    SELECT 'dim_repository' AS table_name, (SELECT count(*) FROM repo) AS n_rows
    UNION ALL SELECT 'dim_user', (SELECT count(*) FROM everyone)
    {_resolved('fact_commits', 'event_id', 'sc')}
    {_resolved('fact_pull_requests', 'github_pr_id', 'sp')}
    {_resolved('fact_issues', 'github_issue_id', 'si')}
    UNION ALL SELECT 'repo_languages', (SELECT count(*) FROM rl)
    UNION ALL SELECT 'rejected_commits', (SELECT count(*) FROM sc WHERE event_id % 97 = 0)"""


_STAR_COUNTS = """
    SELECT 'dim_repository' AS table_name, count(*) AS n_rows FROM customer
    UNION ALL
    SELECT 'dim_user', (SELECT count(*) FROM customer)
        + (SELECT count(DISTINCT user_id) FROM events WHERE event_id % 4 <> 0 AND event_id % 19 <> 0)
    UNION ALL SELECT 'fact_commits', count(*) FROM events WHERE event_id % 19 <> 0
    UNION ALL SELECT 'fact_pull_requests', count(*) FROM orders WHERE o_orderkey % 23 <> 0
    UNION ALL SELECT 'fact_issues', count(*) FROM (
        SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey % 29 <> 0)
    UNION ALL SELECT 'repo_languages', count(*) FROM (
        SELECT DISTINCT l_suppkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey)"""

_CALENDAR = """
    SELECT CAST(strftime(x, '%Y%m%d') AS INTEGER) AS date_id, CAST(x AS DATE) AS full_date,
           CAST(year(x) AS INTEGER) AS year, CAST(quarter(x) AS INTEGER) AS quarter, CAST(month(x) AS INTEGER) AS month,
           monthname(x) AS month_name, CAST(week(x) AS INTEGER) AS week, CAST(day(x) AS INTEGER) AS day_of_month,
           CAST(isodow(x) - 1 AS INTEGER) AS day_of_week, dayname(x) AS day_name, isodow(x) IN (6, 7) AS is_weekend
    FROM (SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS x FROM lineitem)"""


CASES = {
    # Dimensions
    "G1_calendar": (
        lambda spark, d: star.calendar_spanning(table(spark, d, "lineitem"), "l_shipdate"), _CALENDAR,
    ),
    "G2_dim_repository": (
        lambda spark, d: star.dim_repository(silver.clean("repositories", bronze_records(spark, d, "repositories"))).drop(
            "repository_id", "etl_loaded_at"),
        _C1,
    ),
    "G3_dim_user": (
        lambda spark, d: star.dim_user(_user_sources(spark, d)).drop("user_id", "etl_loaded_at"),
        sql("sc", _USERS),
    ),
    "G4_surrogate_keys": (
        _numbered_users,
        sql("sc", f"SELECT count(*) AS n_rows, count(DISTINCT login) AS n_keys, TRUE AS positive FROM ({_USERS})"),
    ),
    "G4_keys_survive_reload": (
        _kept_keys,
        """SELECT count(*) AS n_rows, count(DISTINCT c_name) AS n_keys,
                  count(*) FILTER (WHERE c_name < 'Customer#000000700') AS n_kept FROM customer""",
    ),
    "D3_user_with_id_beats_bare_login": (
        lambda spark, d: star.dim_user(_user_sources(spark, d)).select(
            "login", F.col("github_user_id").isNotNull().alias("has_id")),
        sql("sc", f"SELECT login, github_user_id IS NOT NULL AS has_id FROM ({_USERS})"),
    ),
    "U1_union_of_user_sources": (
        lambda spark, d: reduce(lambda a, b: a.unionByName(b), _user_sources(spark, d)).groupBy("user_type").agg(
            F.count(F.lit(1)).alias("n_rows")),
        sql("sc", """
            SELECT user_type, count(*) AS n_rows FROM (
                SELECT CASE WHEN c_custkey % 10 = 0 THEN 'Bot' ELSE 'User' END AS user_type FROM customer
                UNION ALL SELECT 'User' FROM (SELECT DISTINCT author_login FROM sc)) GROUP BY 1"""),
    ),
    # Facts
    "G5_fact_commits": (
        lambda spark, d: star.fact_commits(bindings.silver_commits(spark, d), *_dims(spark, d)).drop("commit_id"),
        sql("sc usr", _COMMIT_KEYS),
    ),
    "G6_fact_pull_requests": (
        lambda spark, d: star.fact_pull_requests(
            bindings.silver_pull_requests(spark, d), *_dims(spark, d)).drop("pr_id"),
        sql("sp usr", """
            SELECT github_pr_id, CAST(github_pr_id % 1000 AS INTEGER) AS number, repository_id, user_id AS author_id,
                   CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS created_date_id,
                   CAST(strftime(m, '%Y%m%d') AS INTEGER) AS merged_date_id,
                   CAST(strftime(c, '%Y%m%d') AS INTEGER) AS closed_date_id, o_orderpriority AS title,
                   CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'closed' END AS state, m IS NOT NULL AS is_merged,
                   FALSE AS is_draft, 0 AS comments_count, 0 AS review_comments_count, 0 AS commits_count,
                   0 AS additions, 0 AS deletions, 0 AS changed_files, o_orderdate AS created_at, m AS merged_at,
                   c AS closed_at, date_diff('second', o_orderdate, m) / 3600.0 AS time_to_merge_hours
            FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN ms END AS m,
                         CASE WHEN o_orderstatus <> 'O' THEN ms END AS c FROM sp)
            LEFT JOIN repo ON full_name = repository_full_name LEFT JOIN usr ON login = author_login"""),
    ),
    "G7_fact_issues": (
        lambda spark, d: flat(star.fact_issues(bindings.silver_issues(spark, d), *_dims(spark, d)).drop("issue_id")),
        sql("si usr", """
            SELECT github_issue_id, CAST(github_issue_id % 10 AS INTEGER) AS number, repository_id, user_id AS author_id,
                   CAST(strftime(opened, '%Y%m%d') AS INTEGER) AS created_date_id,
                   CAST(strftime(c, '%Y%m%d') AS INTEGER) AS closed_date_id, l_returnflag AS title,
                   CASE l_linestatus WHEN 'O' THEN 'open' ELSE 'closed' END AS state, 0 AS comments_count,
                   l_returnflag AS labels,
                   (SELECT CAST(l_suppkey AS VARCHAR) FROM lines
                    WHERE l_orderkey * 10 + l_linenumber = github_issue_id) AS assignees,
                   CAST(NULL AS VARCHAR) AS milestone, CAST(opened AS TIMESTAMP) AS created_at, c AS closed_at,
                   date_diff('second', CAST(opened AS TIMESTAMP), c) / 3600.0 AS time_to_close_hours
            FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS c FROM si)
            LEFT JOIN repo ON full_name = repository_full_name LEFT JOIN usr ON login = author_login"""),
    ),
    "G8_repo_languages": (
        lambda spark, d: star.language_shares(bronze.normalize("languages", bindings.language_maps(spark, d))).select(
            "repository_full_name", "language", "bytes", F.round("percentage", 8).alias("percentage")),
        """SELECT 'org/repo' || l_suppkey AS repository_full_name, p_type AS language, bytes,
                  round(bytes / sum(bytes) OVER (PARTITION BY l_suppkey) * 100, 8) AS percentage
           FROM (SELECT l_suppkey, p_type, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bytes
                 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)""",
    ),
    "S10_bronze_to_silver_job": (_job, _JOB_COUNTS),
    "G10_column_defaults": (
        lambda spark, d: star.with_defaults("dim_user", bindings.users(spark, d)),
        """SELECT c_custkey AS user_id, CAST(NULL AS BIGINT) AS github_user_id, c_name AS login,
                  CASE WHEN c_custkey % 7 <> 0 THEN 'https://img.example/' || c_custkey END AS avatar_url,
                  'User' AS user_type, CAST(NULL AS VARCHAR) AS html_url, CAST(NULL AS TIMESTAMP) AS etl_loaded_at
           FROM customer""",
    ),
    "G9_star_row_counts": (_star_counts, _STAR_COUNTS),
    "G9_star_loaded_again": (_star_loaded_again, sql("sc sp si usr rl", _LOADED_COUNTS)),
    "U2_table_counts": (
        lambda spark, d: lake.load_report(bind(spark, d).tables()),
        sql("repo usr fc fp fi rl cal", """
            SELECT 'dim_repository' AS table_name, count(*) AS n_rows FROM repo UNION ALL SELECT 'dim_user', count(*) FROM usr
            UNION ALL SELECT 'dim_date', count(*) FROM cal UNION ALL SELECT 'fact_commits', count(*) FROM fc
            UNION ALL SELECT 'fact_pull_requests', count(*) FROM fp UNION ALL SELECT 'fact_issues', count(*) FROM fi
            UNION ALL SELECT 'repo_languages', count(*) FROM rl"""),
    ),
    "J1_repository_lookup": (
        lambda spark, d: star.fact_commits(bindings.silver_commits(spark, d), *_dims(spark, d)).groupBy(
            "repository_id").agg(F.count(F.lit(1)).alias("n_rows")),
        sql("sc usr", f"SELECT repository_id, count(*) AS n_rows FROM ({_COMMIT_KEYS}) GROUP BY 1"),
    ),
    "J2_user_lookup": (
        lambda spark, d: star.fact_commits(bindings.silver_commits(spark, d), *_dims(spark, d)).select(
            "sha", "author_id", "committer_id"),
        sql("sc usr", f"SELECT sha, author_id, committer_id FROM ({_COMMIT_KEYS})"),
    ),
    "J9_records_of_unknown_repositories": (
        _orphans,
        sql("sc", """SELECT sha, repository_full_name FROM sc
                     WHERE NOT EXISTS (SELECT 1 FROM repo WHERE full_name = repository_full_name)"""),
    ),
    # Quality
    "K1_unique_violations": (
        lambda spark, d: quality.unique_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
        """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    ),
    "K2_null_counts": (
        _quality_report,
        sql("sc usr", f"""
            SELECT unnest(['commit_id', 'sha', 'repository_id', 'author_id', 'committer_id']) AS column_name,
                   unnest([0, count(*) - count(sha), count(*) - count(repository_id), count(*) - count(author_id),
                           count(*) - count(committer_id)]) AS n_nulls FROM ({_COMMIT_KEYS})"""),
    ),
    "K3_orphans": (
        lambda spark, d: quality.orphans(
            table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey",
            table(spark, d, "part").filter("p_size <> 11"), "p_partkey"),
        """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
           WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 11)""",
    ),
    "K4_values_outside_the_set": (
        _states_outside, "SELECT o_orderkey AS pr_id, 'draft' AS state FROM orders WHERE o_orderkey % 31 = 0",
    ),
    "K5_texts_too_long": (
        lambda spark, d: flat(quality.too_long(
            table(spark, d, "part").select("p_partkey", "p_name", "p_type"), {"p_name": 10, "p_type": 6})),
        """SELECT p_partkey, p_name, p_type, concat_ws(',', CASE WHEN length(p_name) > 10 THEN 'p_name' END,
                  CASE WHEN length(p_type) > 6 THEN 'p_type' END) AS too_long
           FROM part WHERE length(p_name) > 10 OR length(p_type) > 6""",
    ),
    # Incremental loads
    "E1_upsert": (
        lambda spark, d: incremental.upsert(*_orders_split(spark, d), ["o_orderkey"]), _UPSERTED,
    ),
    "E1_upsert_of_partitions": (
        _upserted_table,
        """SELECT o_orderkey, o_orderpriority, CASE WHEN moved THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                  CAST(year(o_orderdate) AS INTEGER) AS year,
                  CASE WHEN moved THEN 12 ELSE CAST(month(o_orderdate) AS INTEGER) END AS month
           FROM (SELECT *, year(o_orderdate) = 1997 AND o_orderpriority = '2-HIGH' AS moved FROM orders)""",
    ),
    "E1_interrupted_upsert": (
        _interrupted_upsert,
        """SELECT o_orderkey, o_orderpriority, seen,
                  CASE WHEN moved THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                  CAST(year(o_orderdate) AS INTEGER) AS year,
                  CASE WHEN moved THEN 12 ELSE CAST(month(o_orderdate) AS INTEGER) END AS month
           FROM (SELECT *, seen = 'after' AND year(o_orderdate) = 1997 AND o_orderpriority = '2-HIGH' AS moved
                 FROM orders, (VALUES ('opened'), ('during'), ('after')) v(seen))""",
    ),
    "E2_incremental_rows": (
        _incremental,
        """SELECT event_id, event_id % 25 AS repo, ts FROM events e
           WHERE ts >= coalesce((SELECT max(ts) FROM events o WHERE o.event_id % 25 = e.event_id % 25
               AND o.event_id % 25 <> 4 AND o.ts < TIMESTAMP '2024-01-15'), TIMESTAMP '1900-01-01')""",
    ),
}
