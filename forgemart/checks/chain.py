"""The whole way from payloads to marts: two landing days, two loads, and what the loads refuse and log."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemart import bindings, jobs, schemas
from forgemart.bindings import AS_OF
from forgemart.checks import base, marts
from forgemart.checks.base import flat, sql
from forgemart.checks.loads import stored_silver
from forgemart.plans import commits, pulls, repositories
from forgemart.plans.star import Star
from forgemart.session import scratch_path
from forgemart.sources import gold, lake
from forgemart.sources.files import path_exists

_LATE = 1020  # repositories with an id from here on land on the second day
_lakes: dict[tuple[str, str], lake.LakePaths] = {}


def _iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(column)


def _who(column: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("login")))


def _payload(df: DataFrame, *fields: Column | str) -> DataFrame:
    return df.select(F.to_json(F.struct(*fields)).alias("payload"))


def _payloads(spark, d) -> dict[str, DataFrame]:
    """The silver records of the test tables as the API would have sent them; among the contributors some texts are
    broken."""
    tables = bindings.silver_tables(spark, d)
    person = F.struct(_iso("author_date").alias("date"))
    change = F.struct("additions", "deletions", F.col("files_changed").alias("total"))
    seen = F.lit("2024-02-01T00:00:00Z").alias("updated_at")
    repository = F.col("repository_full_name")
    broken = bindings.table(spark, d, "nation").select(F.lit("{not json").alias("payload"))
    return {
        "repositories": _payload(
            tables["repositories"], F.col("github_repo_id").alias("id"), "full_name", "name", _who("owner").alias("owner"),
            "language", F.col("is_fork").alias("fork"), F.col("stars_count").alias("stargazers_count"), "forks_count",
            _iso("created_at"), "html_url", seen),
        "commits": _payload(
            tables["commits"], "sha", F.struct(person.alias("author"), "message").alias("commit"),
            _who("author_login").alias("author"), _who("committer_login").alias("committer"), change.alias("stats"), repository),
        "pull_requests": _payload(
            tables["pull_requests"], F.col("github_pr_id").alias("id"), "number", "title", "state",
            _who("author_login").alias("user"), _iso("created_at"), seen, _iso("closed_at"), _iso("merged_at"), repository),
        "issues": _payload(
            tables["issues"], F.col("github_issue_id").alias("id"), "number", "title", "state",
            _who("author_login").alias("user"), _iso("created_at"), seen, _iso("closed_at"),
            F.transform("labels", lambda x: F.struct(x.alias("name"))).alias("labels"), repository),
        "contributors": _payload(
            tables["contributors"], F.col("github_user_id").alias("id"), "login", "contributions", "avatar_url",
            F.col("user_type").alias("type"), repository).unionByName(broken),
        "languages": _payload(tables["languages"], "languages", repository),
    }


def _lake(spark, d) -> lake.LakePaths:
    """A lake filled by all jobs, once per session: on the second day the late repositories land and the other half of
    the commits; nothing else lands again, and the second load reads changes only."""
    known = _lakes.get((spark.sparkContext.applicationId, d))
    if known is not None and path_exists(spark, known.root):
        return known
    paths = lake.LakePaths(scratch_path(spark, "chain"))
    payloads = _payloads(spark, d)
    late = F.get_json_object("payload", "$.id").cast("long") >= _LATE
    odd = F.pmod(F.crc32(F.get_json_object("payload", "$.sha").cast("binary")), F.lit(2)) == 1
    repos, made = payloads["repositories"], payloads["commits"]
    jobs.ingest(spark, paths, {**payloads, "repositories": repos.filter(~late), "commits": made.filter(~odd)}, date(2024, 2, 1), "in1")
    jobs.bronze_to_silver(spark, paths, run_id="s1")
    jobs.silver_to_gold(spark, paths, "g1")
    jobs.ingest(spark, paths, {"repositories": repos.filter(late), "commits": made.filter(odd)}, date(2024, 2, 2), "in2")
    jobs.bronze_to_silver(spark, paths, since=date(2024, 2, 2), run_id="s2")
    jobs.silver_to_gold(spark, paths, "g2", incremental=True)
    _lakes[spark.sparkContext.applicationId, d] = paths
    return paths


def _star(spark, d) -> Star:
    paths = _lake(spark, d)

    def dim(name):
        return lake.read_table(spark, f"{paths.gold(name)}/load=g2", schemas.gold(name))

    def fact(name):
        return lake.read_table(spark, paths.gold(name), schemas.gold(name)).drop(*gold.PARTITIONS)

    return Star(dim("dim_repository"), dim("dim_user"), dim("dim_date"), fact("fact_commits"),
                fact("fact_pull_requests"), fact("fact_issues"), dim("repo_languages"))


def _late_facts(spark, d):
    """Facts of the repositories that landed a day after them, each once, with the day of their load unseen."""
    star = _star(spark, d)
    names = star.repo.filter(F.col("github_repo_id") >= _LATE).select("repository_id", "full_name")
    kinds = {"commits": (star.commits, "sha"), "pull_requests": (star.prs, "github_pr_id"), "issues": (star.issues, "github_issue_id")}
    return reduce(DataFrame.unionByName, [
        rows.join(names, "repository_id").select(
            F.lit(kind).alias("kind"), F.col(key).cast("string").alias("record"), "full_name")
        for kind, (rows, key) in kinds.items()])


def _run_log(spark, d):
    """The runs of all jobs: those of the two landing days together, the two loads each."""
    log = spark.read.schema(schemas.RUN_LOG_DDL).parquet(_lake(spark, d).run_log())
    run = F.when(F.col("run_id").startswith("g"), F.col("run_id")).otherwise(F.regexp_extract("run_id", "[a-z]+", 0))
    bad = F.size("errors") > 0
    rows = log.filter((F.col("status") == F.when(bad, "completed_with_errors").otherwise("completed")))
    # Which commits landed first is dealt by a checksum: the first load's are not counted.
    first = F.col("run_id") == "g1"
    return rows.withColumns({
        "run": run,
        "errors": F.when(first, F.filter("errors", lambda e: ~e.startswith("fact_commits"))).otherwise(F.col("errors")),
        "total_commits": F.when(~first, F.col("total_commits")),
    }).groupBy("run").agg(
        F.sum("total_commits").alias("total_commits"), F.sum("total_prs").alias("total_prs"),
        F.sum("total_issues").alias("total_issues"), F.sum("repos_processed").cast("int").alias("repos_processed"),
        F.array_join(F.flatten(F.collect_list("errors")), ";").alias("errors"))


def _refused(spark, d):
    """Rows that break constraints of each kind, as a load sets them aside with all reasons."""
    tables = stored_silver(spark, d)
    user, key = F.col("github_user_id"), F.col("github_pr_id")
    tables["contributors"] = tables["contributors"].withColumns({
        "login": F.when(user % 90 == 7, None).when(user % 70 == 5, F.rpad("login", 101, "x")).otherwise(F.col("login")),
        "github_user_id": F.when(user % 50 == 3, user - 1).otherwise(user)})
    tables["pull_requests"] = tables["pull_requests"].withColumns({
        "state": F.when(key % 31 == 0, "draft").otherwise(F.col("state")),
        "number": F.when(key % 37 == 0, None).otherwise(F.col("number"))})
    tables["commits"] = tables["commits"].withColumn(
        "sha", F.when(F.col("sha").startswith("a"), F.rpad("sha", 41, "0")).otherwise(F.col("sha")))
    paths = lake.LakePaths(scratch_path(spark, "lake"))
    gold.load_star(spark, tables, paths, "1", part_cols=["year"])
    keys = {"dim_user": "github_user_id", "fact_pull_requests": "github_pr_id", "fact_commits": "sha", "dim_repository": "full_name"}
    return flat(reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{paths.gold(f'rejected_{name}')}/load=1").select(
            F.lit(name).alias("table_name"), F.col(of).cast("string").alias("record"), "reasons")
        for name, of in keys.items()]))


# The star that the chain must give, with names for the keys it numbers.
_STAR = {
    "usr": f"""
        SELECT login AS user_id, login, coalesce(avatar_url, '') AS avatar_url FROM ({base.TABLES['usr']})
        UNION ALL SELECT DISTINCT author_login, author_login, NULL FROM sc
        WHERE author_login IS NOT NULL AND author_login NOT IN (SELECT c_name FROM customer)""",
    "fc": """
        SELECT event_id AS commit_id, r.repository_id, author_login AS author_id,
               CAST(floor(value * 10) AS INTEGER) AS additions, CAST(floor(value) AS INTEGER) AS deletions,
               date_trunc('second', ts) AS authored_at, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_id
        FROM sc JOIN repo r ON r.full_name = repository_full_name""",
    "fp": """
        SELECT github_pr_id AS pr_id, repository_id, CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'closed' END AS state,
               m IS NOT NULL AS is_merged, date_diff('second', o_orderdate, m) / 3600.0 AS time_to_merge_hours
        FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN ms END AS m FROM sp)
        JOIN repo ON full_name = repository_full_name""",
    "fi": """
        SELECT github_issue_id AS issue_id, repository_id, CASE l_linestatus WHEN 'O' THEN 'open' ELSE 'closed' END AS state,
               date_diff('second', CAST(opened AS TIMESTAMP), CASE WHEN l_linestatus = 'F' THEN l_shipdate END) / 3600.0
                   AS time_to_close_hours
        FROM si JOIN repo ON full_name = repository_full_name""",
}


def _chain_sql(body: str) -> str:
    tables = {**{n: base.TABLES[n] for n in ("repo", "sc", "shipped", "sp", "lines", "si", "rl", "cal")}, **_STAR}
    return f"WITH {', '.join(f'{n} AS ({text})' for n, text in tables.items())} {body}"


_PLACED = "JOIN repo ON full_name = repository_full_name"
_IN_LATE = f"{_PLACED} WHERE github_repo_id >= {_LATE}"
_EARLY = f"github_repo_id < {_LATE}"


def _n(body: str) -> str:
    return f"(SELECT count(*) FROM {body})"


CASES = {
    "S10_chain_repository_overview": (
        lambda spark, d: repositories.repository_overview(_star(spark, d)).drop("repository_id"),
        _chain_sql(f"SELECT * EXCLUDE (repository_id) FROM ({marts._OVERVIEW})"),
    ),
    "S10_chain_daily_commit_activity": (
        lambda spark, d: commits.daily_commit_activity(_star(spark, d)),
        _chain_sql(f"""
            SELECT full_date, year, month, day_name, is_weekend, full_name AS repository, {marts._ACTIVITY}
            FROM fc JOIN cal USING (date_id) JOIN repo USING (repository_id)
            GROUP BY full_date, year, month, day_name, is_weekend, full_name"""),
    ),
    "S10_chain_pr_metrics": (
        lambda spark, d: pulls.pr_metrics(_star(spark, d)).drop("repository_id"),
        _chain_sql(f"""
            SELECT full_name AS repository, {marts._PR_COUNTS}
            FROM fp JOIN repo USING (repository_id) GROUP BY full_name"""),
    ),
    "S10_chain_top_contributors": (
        lambda spark, d: commits.top_contributors(_star(spark, d)), _chain_sql(marts._CONTRIBUTORS.format(where="")),
    ),
    "G9_chain_summary": (
        lambda spark, d: marts._summary_text(_star(spark, d)), _chain_sql(marts._SUMMARY_BODY),
    ),
    "J9_facts_before_their_repository": (
        _late_facts,
        sql("sc sp si", f"""
            SELECT 'commits' AS kind, md5(CAST(event_id AS VARCHAR)) AS record, repo.full_name
                FROM sc JOIN repo ON repo.full_name = repository_full_name WHERE repo.github_repo_id >= {_LATE}
            UNION ALL SELECT 'pull_requests', CAST(github_pr_id AS VARCHAR), full_name FROM sp {_IN_LATE}
            UNION ALL SELECT 'issues', CAST(github_issue_id AS VARCHAR), full_name FROM si {_IN_LATE}"""),
    ),
    "K1_K5_load_rejects": (
        _refused,
        sql("sc sp", """
            SELECT 'dim_user' AS table_name, CAST(CASE WHEN c_custkey % 50 = 3 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR)
                       AS record,
                   CASE WHEN c_custkey % 90 = 7 THEN 'login is null' WHEN c_custkey % 70 = 5 THEN 'login has over 100 characters'
                        ELSE 'github_user_id occurs twice' END AS reasons
            FROM customer WHERE c_custkey % 90 = 7 OR c_custkey % 70 = 5 OR c_custkey % 50 = 3
            UNION ALL
            SELECT 'fact_pull_requests', CAST(github_pr_id AS VARCHAR), concat_ws(',',
                CASE WHEN github_pr_id % 37 = 0 THEN 'number is null' END,
                CASE WHEN github_pr_id % 97 = 0 THEN 'repository_id is null' END,
                CASE WHEN github_pr_id % 31 = 0 THEN 'state is not one of open, closed' END)
            FROM sp WHERE github_pr_id % 37 = 0 OR github_pr_id % 97 = 0 OR github_pr_id % 31 = 0
            UNION ALL
            SELECT 'fact_commits', CASE WHEN sha[1] = 'a' THEN rpad(sha, 41, '0') ELSE sha END, concat_ws(',',
                CASE WHEN event_id % 97 = 0 THEN 'repository_id is null' END,
                CASE WHEN sha[1] = 'a' THEN 'sha has over 40 characters' END)
            FROM sc WHERE event_id % 97 = 0 OR sha[1] = 'a'"""),
    ),
    # CRC-32 is not in the SQL: of the commits only those of both days and of the loads are counted.
    "N14_job_run_log": (
        _run_log,
        sql("sc sp si", f"""
            , n AS (SELECT {_n('sc')} AS c, {_n('sp')} AS p, {_n('si')} AS i,
                           {_n(f'sc s JOIN repo r ON r.full_name = s.repository_full_name')} AS placed,
                           {_n(f'sp {_IN_LATE}')} AS late_p, {_n(f'si {_IN_LATE}')} AS late_i,
                           {_n(f'sp {_PLACED} WHERE {_EARLY}')} AS early_p, {_n(f'si {_PLACED} WHERE {_EARLY}')} AS early_i)
            SELECT 'in' AS run, c AS total_commits, p AS total_prs, i AS total_issues, 25 AS repos_processed,
                   'contributors: 25 unreadable payloads' AS errors FROM n
            UNION ALL SELECT 's', c, p, i, 25, '' FROM n
            UNION ALL SELECT 'g1', NULL, early_p, early_i, 20,
                             'fact_issues: ' || (i - early_i) || ' rows rejected;fact_pull_requests: ' || (p - early_p) || ' rows rejected' FROM n
            UNION ALL SELECT 'g2', placed, late_p, late_i, 25,
                             'fact_commits: ' || (c - placed) || ' rows rejected;fact_issues: ' || (i - early_i - late_i)
                             || ' rows rejected;fact_pull_requests: ' || (p - early_p - late_p) || ' rows rejected' FROM n"""),
    ),
}
