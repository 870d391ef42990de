"""Views, API queries, aggregates, joins, limits and derived metrics on the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from forgemart.bindings import AS_OF, bind
from forgemart.checks.base import sql
from forgemart.functions import numbers, times
from forgemart.operators import keys, median
from forgemart.plans import commits, dashboard, issues, params, partials, pulls, repositories
from forgemart.session import scratch_path
from forgemart.sources import versions


def _on(query):
    return lambda spark, sf_dir: query(bind(spark, sf_dir))


_OVERVIEW = """
    SELECT r.repository_id, full_name, owner, name, description, language, stars_count, forks_count, is_fork,
           created_at, html_url,
           (SELECT count(*) FROM fc WHERE fc.repository_id = r.repository_id) AS total_commits,
           (SELECT count(*) FROM fp WHERE fp.repository_id = r.repository_id) AS total_prs,
           (SELECT count(*) FROM fi WHERE fi.repository_id = r.repository_id) AS total_issues,
           (SELECT CAST(coalesce(sum(additions), 0) AS BIGINT) FROM fc WHERE fc.repository_id = r.repository_id)
               AS total_additions,
           (SELECT CAST(coalesce(sum(deletions), 0) AS BIGINT) FROM fc WHERE fc.repository_id = r.repository_id)
               AS total_deletions
    FROM repo r"""
_OVER = "repo fc fp fi"

_ROUNDED = "CAST(round(CAST({} AS DECIMAL(38, 6)), 1) AS DOUBLE)"


def _r1(x: str) -> str:
    return _ROUNDED.format(x)


_PR_COUNTS = f"""
    count(*) AS total_prs, count(*) FILTER (WHERE state = 'open') AS open_prs,
    count(*) FILTER (WHERE is_merged) AS merged_prs,
    count(*) FILTER (WHERE state = 'closed' AND NOT is_merged) AS closed_unmerged,
    {_r1('avg(time_to_merge_hours)')} AS avg_merge_time_hours,
    {_r1('percentile_cont(0.5) WITHIN GROUP (ORDER BY time_to_merge_hours)')} AS median_merge_time_hours"""
_PR_RATE = f"CASE WHEN count(*) > 0 THEN {_r1('count(*) FILTER (WHERE is_merged) * 100.0 / count(*)')} END AS merge_rate_pct"
_ISSUE_COUNTS = f"""
    count(*) AS total_issues, count(*) FILTER (WHERE state = 'open') AS open_issues,
    count(*) FILTER (WHERE state = 'closed') AS closed_issues,
    {_r1('avg(time_to_close_hours)')} AS avg_close_time_hours,
    {_r1('percentile_cont(0.5) WITHIN GROUP (ORDER BY time_to_close_hours)')} AS median_close_time_hours"""
_ACTIVITY = """
    count(commit_id) AS commit_count, count(DISTINCT author_id) AS unique_authors,
    CAST(coalesce(sum(additions), 0) AS BIGINT) AS additions,
    CAST(coalesce(sum(deletions), 0) AS BIGINT) AS deletions"""
_CONTRIBUTORS = """
    SELECT login, avatar_url, count(DISTINCT commit_id) AS total_commits,
           count(DISTINCT repository_id) AS repos_contributed_to,
           CAST(coalesce(sum(additions), 0) AS BIGINT) AS total_additions,
           CAST(coalesce(sum(deletions), 0) AS BIGINT) AS total_deletions,
           min(authored_at) AS first_commit, max(authored_at) AS last_commit
    FROM usr JOIN fc ON user_id = author_id {where}
    GROUP BY user_id, login, avatar_url ORDER BY total_commits DESC, login"""
_MIX = f"""
    SELECT language, CAST(sum(bytes) AS BIGINT) AS total_bytes, count(DISTINCT repository_id) AS repo_count,
           {_r1('sum(bytes) * 100.0 / nullif(sum(sum(bytes)) OVER (), 0)')} AS percentage
    FROM rl GROUP BY language ORDER BY total_bytes DESC, language LIMIT {{limit}}"""
_CELLS = """
    SELECT day_of_week, day_name, CAST(hour(authored_at) AS INTEGER) AS hour, count(*) AS commit_count
    FROM fc JOIN cal USING (date_id) {where} GROUP BY ALL"""
_GRID = f"""
    SELECT d.d AS day_of_week, h.h AS hour, coalesce(c.commit_count, 0) AS commit_count
    FROM (SELECT CAST(unnest(range(7)) AS INTEGER) AS d) d
    CROSS JOIN (SELECT CAST(unnest(range(24)) AS INTEGER) AS h) h
    LEFT JOIN ({_CELLS.format(where='')}) c ON c.day_of_week = d.d AND c.hour = h.h"""


def _timeline_sql(unit: str, limit: int, where: str = "") -> str:
    return sql("fc cal", f"""
        SELECT * FROM (SELECT CAST(date_trunc('{unit}', full_date) AS DATE) AS date, {_ACTIVITY}
        FROM fc JOIN cal USING (date_id) {where} GROUP BY 1 ORDER BY date DESC LIMIT {limit}) ORDER BY date""")


def _pr_timeline_sql(unit: str, limit: int, where: str = "") -> str:
    return sql("fp cal", f"""
        SELECT CAST(date_trunc('{unit}', full_date) AS DATE) AS date,
               count(*) FILTER (WHERE created_date_id = date_id) AS opened,
               count(*) FILTER (WHERE merged_date_id = date_id) AS merged,
               count(*) FILTER (WHERE closed_date_id = date_id AND NOT is_merged) AS closed
        FROM fp JOIN cal ON date_id IN (created_date_id, merged_date_id, closed_date_id)
        {where} GROUP BY 1 ORDER BY date DESC LIMIT {limit}""")


def _trend_sql(unit: str, limit: int) -> str:
    return sql("fp", f"""
        SELECT CAST(date_trunc('{unit}', merged_at) AS DATE) AS date, {_r1('avg(time_to_merge_hours)')} AS avg_hours,
               {_r1('median(time_to_merge_hours)')} AS median_hours, count(*) AS merged_count
        FROM fp WHERE is_merged GROUP BY 1 ORDER BY date DESC LIMIT {limit}""")


def _issue_timeline_sql(unit: str, limit: int) -> str:
    return sql("fi", f"""
        SELECT date, CAST(sum(o) AS BIGINT) AS opened, CAST(sum(c) AS BIGINT) AS closed FROM (
            SELECT CAST(date_trunc('{unit}', created_at) AS DATE) AS date, 1 AS o, 0 AS c FROM fi
            UNION ALL
            SELECT CAST(date_trunc('{unit}', closed_at) AS DATE), 0, 1 FROM fi WHERE closed_at IS NOT NULL)
        GROUP BY date ORDER BY date DESC LIMIT {limit}""")


def _dense_sql(body_tables: str = "fc cal") -> str:
    return f"""
        SELECT full_date AS date, count(commit_id) AS commit_count, count(DISTINCT author_id) AS unique_authors,
               CAST(coalesce(sum(additions), 0) AS BIGINT) AS additions,
               CAST(coalesce(sum(deletions), 0) AS BIGINT) AS deletions
        FROM cal LEFT JOIN fc USING (date_id)
        WHERE full_date BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' GROUP BY full_date"""


_COUNTS = """
    SELECT (SELECT count(*) FROM repo) AS total_repositories, (SELECT count(*) FROM fc) AS total_commits,
           (SELECT count(*) FROM fp) AS total_pull_requests, (SELECT count(*) FROM fi) AS total_issues,
           (SELECT count(DISTINCT login) FROM usr) AS total_contributors,
           (SELECT CAST(coalesce(sum(stars_count), 0) AS BIGINT) FROM repo) AS total_stars,
           (SELECT CAST(coalesce(sum(forks_count), 0) AS BIGINT) FROM repo) AS total_forks"""


def _summary_text(star):
    """The summary row with its arrays as text, so that any client can compare it."""
    row = dashboard.dashboard_summary(star, AS_OF)

    def lines(name, *fields):
        return F.array_join(
            F.transform(name, lambda r: F.concat_ws("|", *[r[f].cast("string") for f in fields])), ";"
        ).alias(name)

    return row.select(
        *[c for c in row.columns if c not in (
            "commit_timeline", "top_contributors", "language_distribution", "pr_stats", "issue_stats")],
        lines("commit_timeline", "date", "commit_count", "unique_authors", "additions", "deletions"),
        lines("top_contributors", "login", "total_commits", "repos_contributed_to", "total_additions"),
        lines("language_distribution", "language", "total_bytes", "repo_count"),
        F.col("pr_stats.merge_rate_pct").alias("merge_rate_pct"),
        F.col("pr_stats.closed_unmerged").alias("closed_unmerged"),
        F.col("issue_stats.median_close_time_hours").alias("median_close_time_hours"),
    )


_SUMMARY_BODY = f"""
    SELECT k.*, (SELECT language FROM rl GROUP BY language ORDER BY sum(bytes) DESC, language LIMIT 1) AS top_language,
        (SELECT count(*) FROM fc WHERE authored_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY) AS recent_commits_30d,
        (SELECT string_agg(concat_ws('|', date, commit_count, unique_authors, additions, deletions), ';' ORDER BY date)
         FROM ({_dense_sql()})) AS commit_timeline,
        (SELECT string_agg(concat_ws('|', login, total_commits, repos_contributed_to, total_additions), ';'
                           ORDER BY total_commits DESC, login)
         FROM ({_CONTRIBUTORS.format(where='')} LIMIT 10)) AS top_contributors,
        (SELECT string_agg(concat_ws('|', language, total_bytes, repo_count), ';' ORDER BY total_bytes DESC, language)
         FROM ({_MIX.format(limit=15)})) AS language_distribution,
        p.merge_rate_pct, p.closed_unmerged, p.avg_merge_time_hours, i.open_issues, i.median_close_time_hours
    FROM ({_COUNTS}) k, (SELECT {_PR_COUNTS}, {_PR_RATE} FROM fp) p, (SELECT {_ISSUE_COUNTS} FROM fi) i"""
_SUMMARY_SQL = sql("repo usr fc fp fi rl cal", _SUMMARY_BODY)


def _joined_dates(star):
    """Fact rows with their calendar day."""
    return star.prs.join(star.date, star.prs.created_date_id == star.date.date_id).select(
        "pr_id", "full_date", "day_name", "is_weekend"
    )


def _from_partials(query):
    """A query over stored daily partials of the commits."""

    def run(spark, sf_dir):
        star, path = bind(spark, sf_dir), scratch_path(spark, "partials")
        rows = partials.daily_partials(star.commits)
        versions.replace(spark, path, rows)
        return query(versions.read(spark, path, rows.schema), star)

    return run


def _fanned_out(star):
    """The sums as BIGINT, as the SQL has them; one beyond BIGINT, where the SQL's own cast fails, is null."""
    overview = repositories.repository_overview(star, compat_fanout=True)
    return overview.withColumns({c: F.col(c).try_cast("bigint") for c in repositories.FANNED_OUT})


CASES = {
    # Views
    "V1_repository_overview": (_on(repositories.repository_overview), sql(_OVER, _OVERVIEW)),
    "V1_repository_overview_fanout": (
        _on(_fanned_out),
        sql(_OVER, f"""
            SELECT * REPLACE (
                CAST(total_additions * greatest(total_prs, 1) * greatest(total_issues, 1) AS BIGINT) AS total_additions,
                CAST(total_deletions * greatest(total_prs, 1) * greatest(total_issues, 1) AS BIGINT) AS total_deletions)
            FROM ({_OVERVIEW})"""),
    ),
    "V2_daily_commit_activity": (
        _on(commits.daily_commit_activity),
        sql("repo fc cal", f"""
            SELECT full_date, year, month, day_name, is_weekend, full_name AS repository, {_ACTIVITY}
            FROM fc JOIN cal USING (date_id) JOIN repo USING (repository_id)
            GROUP BY full_date, year, month, day_name, is_weekend, full_name"""),
    ),
    "V3_pr_metrics": (
        _on(pulls.pr_metrics),
        sql("repo fp", f"""
            SELECT full_name AS repository, repository_id, {_PR_COUNTS}
            FROM fp JOIN repo USING (repository_id) GROUP BY full_name, repository_id"""),
    ),
    "V4_top_contributors": (_on(commits.top_contributors), sql("usr fc", _CONTRIBUTORS.format(where=""))),
    # API queries
    "Q1_list_repositories_by_commits": (
        _on(lambda s: repositories.list_repositories(s, sort_by="total_commits", limit=10, offset=5)),
        sql(_OVER, f"SELECT * FROM ({_OVERVIEW}) ORDER BY total_commits DESC, repository_id LIMIT 10 OFFSET 5"),
    ),
    "Q1_list_repositories_by_stars": (
        _on(lambda s: repositories.list_repositories(s, limit=7, offset=2)),
        sql(_OVER, f"SELECT * FROM ({_OVERVIEW}) ORDER BY stars_count DESC, repository_id LIMIT 7 OFFSET 2"),
    ),
    "Q1_list_repositories_of_language": (
        _on(lambda s: repositories.list_repositories(s, sort_by="name", order="asc", language="Go")),
        sql(_OVER, f"SELECT * FROM ({_OVERVIEW}) WHERE language = 'Go' ORDER BY name LIMIT 50"),
    ),
    "Q2_count_repositories": (
        _on(lambda s: repositories.count_repositories(s, "Rust")),
        sql(_OVER, f"SELECT count(*) AS total_count FROM ({_OVERVIEW}) WHERE language = 'Rust'"),
    ),
    "Q3_get_repository": (
        _on(lambda s: repositories.get_repository(s, 7)), sql(_OVER, f"{_OVERVIEW} WHERE r.repository_id = 7"),
    ),
    "Q4_unique_languages": (
        _on(repositories.unique_languages),
        sql("repo", "SELECT DISTINCT language FROM repo WHERE language IS NOT NULL"),
    ),
    "Q5_commit_timeline_daily": (_on(commits.commit_timeline), _timeline_sql("day", 90)),
    "Q5_commit_timeline_weekly": (
        _on(lambda s: commits.commit_timeline(s, "weekly", 7, repository_id=3)),
        _timeline_sql("week", 7, "WHERE repository_id = 3"),
    ),
    "Q5_commit_timeline_monthly": (
        _on(lambda s: commits.commit_timeline(s, "monthly", 12)), _timeline_sql("month", 12),
    ),
    "Q6_total_commits": (
        _on(lambda s: commits.total_commits(s, 3)),
        sql("fc", "SELECT count(*) AS total_commits FROM fc WHERE repository_id = 3"),
    ),
    "Q7_top_contributors_of_repository": (
        _on(lambda s: commits.top_contributors(s, repository_id=4, limit=20)),
        sql("usr fc", _CONTRIBUTORS.format(where="WHERE repository_id = 4") + " LIMIT 20"),
    ),
    "Q8_commit_heatmap": (_on(commits.commit_heatmap), sql("fc cal", _CELLS.format(where=""))),
    "Q8_commit_heatmap_filtered": (
        _on(lambda s: commits.commit_heatmap(s, repository_id=5, year=2024)),
        sql("fc cal", _CELLS.format(where="WHERE repository_id = 5 AND year = 2024")),
    ),
    "Q9_pr_stats_of_repository": (
        _on(lambda s: pulls.pr_stats(s, 6)),
        sql("fp", f"SELECT {_PR_COUNTS}, {_PR_RATE} FROM fp WHERE repository_id = 6"),
    ),
    "Q10_pr_timeline_weekly": (_on(pulls.pr_timeline), _pr_timeline_sql("week", 52)),
    "Q10_pr_timeline_daily": (
        _on(lambda s: pulls.pr_timeline(s, "daily", 200, repository_id=2)),
        _pr_timeline_sql("day", 200, "WHERE repository_id = 2"),
    ),
    "Q10_pr_timeline_monthly": (_on(lambda s: pulls.pr_timeline(s, "monthly", 100)), _pr_timeline_sql("month", 100)),
    "Q11_merge_time_trend_monthly": (_on(pulls.merge_time_trend), _trend_sql("month", 12)),
    "Q11_merge_time_trend_weekly": (_on(lambda s: pulls.merge_time_trend(s, "weekly", 52)), _trend_sql("week", 52)),
    "Q12_core_counts": (_on(dashboard.core_counts), sql("repo usr fc fp fi", _COUNTS)),
    "Q13_top_language": (
        _on(dashboard.top_language),
        sql("rl", "SELECT language FROM rl GROUP BY language ORDER BY sum(bytes) DESC, language LIMIT 1"),
    ),
    "Q14_pr_stats": (_on(pulls.pr_stats), sql("fp", f"SELECT {_PR_COUNTS}, {_PR_RATE} FROM fp")),
    "Q15_issue_stats": (_on(issues.issue_stats), sql("fi", f"SELECT {_ISSUE_COUNTS} FROM fi")),
    "Q16_recent_commits": (
        _on(lambda s: commits.recent_commits(s, F.lit(AS_OF), 10)),
        sql("fc", f"SELECT count(*) AS recent_commits FROM fc WHERE authored_at >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY"),
    ),
    "A2_weekly_timeline_from_partials": (
        _from_partials(lambda p, s: partials.commit_timeline(p, s.date, "weekly", 8)), _timeline_sql("week", 8),
    ),
    "A2_monthly_timeline_from_partials": (
        _from_partials(lambda p, s: partials.commit_timeline(p, s.date, "monthly", 12)), _timeline_sql("month", 12),
    ),
    "V2_daily_activity_from_partials": (
        _from_partials(partials.daily_commit_activity),
        sql("repo fc cal", f"""
            SELECT full_date, year, month, day_name, is_weekend, full_name AS repository, {_ACTIVITY}
            FROM fc JOIN cal USING (date_id) JOIN repo USING (repository_id)
            GROUP BY full_date, year, month, day_name, is_weekend, full_name"""),
    ),
    "Q17_dense_commit_timeline": (
        _on(lambda s: commits.dense_commit_timeline(s, AS_OF)), sql("fc cal", _dense_sql()),
    ),
    "Q18_top_ten_contributors": (
        _on(lambda s: commits.top_contributors(s, limit=10)),
        sql("usr fc", _CONTRIBUTORS.format(where="") + " LIMIT 10"),
    ),
    "Q19_language_distribution": (_on(dashboard.language_distribution), sql("rl", _MIX.format(limit=15))),
    "Q20_dashboard_summary": (_on(_summary_text), _SUMMARY_SQL),
    "Q21_issue_timeline": (_on(issues.issue_timeline), _issue_timeline_sql("week", 52)),
    "Q22_label_distribution": (
        _on(issues.label_distribution),
        sql("fi", """
            SELECT label, count(*) AS count FROM (
                SELECT o_orderpriority AS label FROM fi UNION ALL SELECT l_returnflag FROM fi) GROUP BY label"""),
    ),
    # Parameter filters
    "P7_optional_filters": (
        _on(lambda s: params.where_equal(s.repo, language="Java", owner=None, is_fork=False).select("full_name")),
        sql("repo", "SELECT full_name FROM repo WHERE language = 'Java' AND NOT is_fork"),
    ),
    "P8_relative_time_filter": (
        _on(lambda s: commits.recent_commits(s, F.lit(AS_OF), 5)),
        sql("fc", f"SELECT count(*) AS recent_commits FROM fc WHERE authored_at >= TIMESTAMP '{AS_OF}' - INTERVAL 5 DAY"),
    ),
    # Joins on the star
    "J3_fact_to_calendar": (
        _on(_joined_dates),
        sql("fp cal", """
            SELECT pr_id, full_date, day_name, is_weekend FROM fp JOIN cal ON created_date_id = date_id"""),
    ),
    "J4_dense_calendar": (
        _on(lambda s: commits.dense_commit_timeline(s, AS_OF, days=45)),
        sql("fc cal", _dense_sql().replace("- 30", "- 45")),
    ),
    "J5_any_of_three_dates": (
        _on(lambda s: keys.touched_dates(
            s.prs.select("pr_id", "created_date_id", "merged_date_id", "closed_date_id"),
            ["created_date_id", "merged_date_id", "closed_date_id"],
        ).join(s.date.select("date_id", "full_date"), "date_id").select("pr_id", "full_date")),
        sql("fp cal", """
            SELECT pr_id, full_date FROM fp JOIN cal ON date_id IN (created_date_id, merged_date_id, closed_date_id)"""),
    ),
    "J6_dimension_to_three_facts": (
        _on(lambda s: repositories.repository_overview(s).select(
            "repository_id", "total_commits", "total_prs", "total_issues")),
        sql("repo fc fp fi", """
            SELECT repository_id, coalesce(a.n, 0) AS total_commits, coalesce(b.n, 0) AS total_prs,
                   coalesce(c.n, 0) AS total_issues
            FROM repo LEFT JOIN (SELECT repository_id, count(*) AS n FROM fc GROUP BY 1) a USING (repository_id)
            LEFT JOIN (SELECT repository_id, count(*) AS n FROM fp GROUP BY 1) b USING (repository_id)
            LEFT JOIN (SELECT repository_id, count(*) AS n FROM fi GROUP BY 1) c USING (repository_id)"""),
    ),
    "J7_user_to_commits": (
        _on(lambda s: s.commits.join(s.user, s.commits.author_id == s.user.user_id).select("commit_id", "login")),
        sql("usr fc", "SELECT commit_id, login FROM usr JOIN fc ON user_id = author_id"),
    ),
    "J8_facts_to_repository": (
        _on(lambda s: s.issues.join(s.repo, "repository_id").select("issue_id", "full_name")),
        sql("repo fi", "SELECT issue_id, full_name FROM fi JOIN repo USING (repository_id)"),
    ),
    # Aggregates
    "A1_counts": (
        _on(lambda s: s.prs.agg(F.count(F.lit(1)).alias("n_rows"), F.count("merged_at").alias("n_merged"))),
        sql("fp", "SELECT count(*) AS n_rows, count(merged_at) AS n_merged FROM fp"),
    ),
    "A2_count_distinct": (
        _on(lambda s: s.commits.groupBy("repository_id").agg(F.count_distinct("author_id").alias("n_authors"))),
        sql("fc", "SELECT repository_id, count(DISTINCT author_id) AS n_authors FROM fc GROUP BY 1"),
    ),
    "A3_conditional_counts": (
        _on(lambda s: s.issues.groupBy("repository_id").agg(
            F.count_if(F.col("state") == "open").alias("open_issues"),
            F.count_if(F.col("state") == "closed").alias("closed_issues"))),
        sql("fi", """
            SELECT repository_id, count(*) FILTER (WHERE state = 'open') AS open_issues,
                   count(*) FILTER (WHERE state = 'closed') AS closed_issues FROM fi GROUP BY 1"""),
    ),
    "A4_median": (
        _on(lambda s: median.grouped_median(s.issues, ["author_id"], "time_to_close_hours", "median_hours")),
        sql("fi", """
            SELECT author_id, percentile_cont(0.5) WITHIN GROUP (ORDER BY time_to_close_hours) AS median_hours
            FROM fi WHERE time_to_close_hours IS NOT NULL GROUP BY 1"""),
    ),
    "A5_rounded_mean": (
        _on(lambda s: s.prs.groupBy("author_id").agg(
            numbers.one_place(F.avg("time_to_merge_hours")).alias("avg_hours"))),
        sql("fp", f"SELECT author_id, {_r1('avg(time_to_merge_hours)')} AS avg_hours FROM fp GROUP BY 1"),
    ),
    "A6_sum_or_zero": (
        _on(lambda s: s.user.join(s.commits, s.user.user_id == s.commits.author_id, "left").groupBy("login").agg(
            numbers.long_sum(F.col("additions")).alias("additions"))),
        sql("usr fc", """
            SELECT login, CAST(coalesce(sum(additions), 0) AS BIGINT) AS additions
            FROM usr LEFT JOIN fc ON user_id = author_id GROUP BY login"""),
    ),
    "A7_first_and_last": (
        _on(lambda s: s.commits.groupBy("author_id").agg(
            F.min("authored_at").alias("first_commit"), F.max("authored_at").alias("last_commit"))),
        sql("fc", "SELECT author_id, min(authored_at) AS first_commit, max(authored_at) AS last_commit FROM fc GROUP BY 1"),
    ),
    "A8_global_aggregate_of_nothing": (
        _on(lambda s: pulls.pr_stats(s, repository_id=0)),
        sql("fp", f"SELECT {_PR_COUNTS}, {_PR_RATE} FROM fp WHERE repository_id = 0"),
    ),
    "A9_guarded_ratio": (
        _on(lambda s: s.prs.groupBy("repository_id").agg(
            numbers.percent_of(F.count_if("is_merged"), F.count(F.lit(1))).alias("merge_rate_pct"))),
        sql("fp", f"SELECT repository_id, {_PR_RATE} FROM fp GROUP BY 1"),
    ),
    "A10_group_by_period": (
        _on(lambda s: s.prs.groupBy(times.period_start("weekly", F.col("created_at")).alias("week")).agg(
            F.count(F.lit(1)).alias("opened"))),
        sql("fp", "SELECT CAST(date_trunc('week', created_at) AS DATE) AS week, count(*) AS opened FROM fp GROUP BY 1"),
    ),
    "W1_share_of_total": (
        _on(lambda s: commits.share_of_all(
            s.commits.groupBy("author_id").agg(F.sum("additions").alias("lines")), "lines", "share_pct")),
        sql("fc", f"""
            SELECT author_id, CAST(sum(additions) AS BIGINT) AS lines,
                   {_r1('sum(additions) * 100.0 / sum(sum(additions)) OVER ()')} AS share_pct FROM fc GROUP BY 1"""),
    ),
    # Sorts and limits, distinct
    "T1_page_of_repositories": (
        _on(lambda s: repositories.list_repositories(s, "forks_count", "asc", limit=9, offset=3)),
        sql(_OVER, f"SELECT * FROM ({_OVERVIEW}) ORDER BY forks_count, repository_id LIMIT 9 OFFSET 3"),
    ),
    "T2_last_periods": (
        _on(lambda s: commits.commit_timeline(s, "daily", 7)), _timeline_sql("day", 7),
    ),
    "T3_top_languages": (_on(lambda s: dashboard.language_distribution(s, 3)), sql("rl", _MIX.format(limit=3))),
    "D4_distinct": (
        _on(lambda s: s.issues.select("author_id", "state").distinct()),
        sql("fi", "SELECT DISTINCT author_id, state FROM fi"),
    ),
    # Derived metrics
    "H1_close_rate": (
        _on(lambda s: issues.close_rate(issues.issue_stats(s))),
        sql("fi", """
            SELECT CAST(floor(count(*) FILTER (WHERE state = 'closed') * 100.0 / count(*) + 0.5) AS BIGINT)
                AS close_rate_pct FROM fi"""),
    ),
    "H2_state_shares": (
        _on(lambda s: pulls.state_shares(
            pulls.pr_stats(s), "total_prs", ["open_prs", "merged_prs", "closed_unmerged"])),
        sql("fp", f"""
            SELECT least(open_prs / greatest(total_prs, 1) * 100, 100.0) AS open_prs_pct,
                   least(merged_prs / greatest(total_prs, 1) * 100, 100.0) AS merged_prs_pct,
                   least(closed_unmerged / greatest(total_prs, 1) * 100, 100.0) AS closed_unmerged_pct
            FROM (SELECT {_PR_COUNTS} FROM fp)"""),
    ),
    "H3_contributor_shares": (
        _on(commits.contributor_shares),
        sql("usr fc", f"""
            SELECT CAST(row_number() OVER (ORDER BY total_commits DESC, login) AS INTEGER) AS rank, login, total_commits,
                   total_commits / max(total_commits) OVER () * 100 AS share_of_top
            FROM ({_CONTRIBUTORS.format(where='')} LIMIT 10)"""),
    ),
    "H4_dense_heatmap": (_on(lambda s: commits.commit_heatmap(s, dense=True)), sql("fc cal", _GRID)),
    "H5_heat_levels": (
        _on(lambda s: commits.heat_levels(commits.commit_heatmap(s, repository_id=None, dense=True))),
        sql("fc cal", f"""
            SELECT *, CAST(CASE WHEN commit_count = 0 THEN 0 WHEN r < 0.15 THEN 1 WHEN r < 0.35 THEN 2
                WHEN r < 0.60 THEN 3 WHEN r < 0.80 THEN 4 ELSE 5 END AS INTEGER) AS level
            FROM (SELECT *, commit_count / max(commit_count) OVER () AS r FROM ({_GRID}))""").replace(
                "SELECT *, CAST(CASE", "SELECT * EXCLUDE (r), CAST(CASE"),
    ),
    "H6_top_eight_languages": (
        _on(lambda s: dashboard.language_distribution(s, 8)), sql("rl", _MIX.format(limit=8)),
    ),
    "H7_page_info": (
        _on(lambda s: repositories.page_info(repositories.count_repositories(s), limit=20, offset=20)),
        sql("repo", """
            SELECT CAST(21 AS BIGINT) AS first_row, least(40, count(*)) AS last_row, count(*) AS total_count,
                   TRUE AS has_previous, 40 < count(*) AS has_next FROM repo"""),
    ),
}
