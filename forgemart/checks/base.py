"""Shared SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The star schema of the test tables, written from the tables rather than from the DataFrame code.
TABLES = {
    "repo": """
        SELECT CAST(n_nationkey + 1 AS BIGINT) AS repository_id,
               CAST(n_nationkey + 1000 AS BIGINT) AS github_repo_id,
               r_name || '/' || n_name AS full_name, r_name AS owner, n_name AS name,
               CAST(NULL AS VARCHAR) AS description,
               CASE n_nationkey % 5 WHEN 0 THEN 'Python' WHEN 1 THEN 'Go' WHEN 2 THEN 'Rust'
                                    WHEN 3 THEN 'Java' END AS language,
               CAST((n_nationkey * 37) % 101 AS INTEGER) AS stars_count,
               CAST((n_nationkey * 13) % 17 AS INTEGER) AS forks_count,
               n_nationkey % 3 = 0 AS is_fork,
               TIMESTAMP '2019-06-01' + to_days(n_nationkey) AS created_at,
               'https://code.example/' || r_name || '/' || n_name AS html_url
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "usr": """
        SELECT c_custkey AS user_id, c_name AS login,
               CASE WHEN c_custkey % 7 <> 0 THEN 'https://img.example/' || c_custkey END AS avatar_url
        FROM customer""",
    "fc": """
        SELECT event_id AS commit_id, event_id % 25 + 1 AS repository_id, user_id AS author_id,
               CAST(floor(value * 10) AS INTEGER) AS additions, CAST(floor(value) AS INTEGER) AS deletions,
               ts AS authored_at, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_id
        FROM events""",
    "shipped": """
        SELECT o.*, (SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey) AS ms FROM orders o""",
    "fp": """
        SELECT *, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS created_date_id,
               CAST(strftime(merged_at, '%Y%m%d') AS INTEGER) AS merged_date_id,
               CAST(strftime(closed_at, '%Y%m%d') AS INTEGER) AS closed_date_id,
               epoch(merged_at - created_at) / 3600.0 AS time_to_merge_hours
        FROM (SELECT o_orderkey AS pr_id, o_orderkey % 25 + 1 AS repository_id, o_custkey AS author_id,
                     o_orderdate AS created_at,
                     CASE WHEN o_orderstatus = 'F' THEN ms END AS merged_at,
                     CASE WHEN o_orderstatus IN ('F', 'P') THEN ms END AS closed_at,
                     CASE WHEN o_orderstatus IN ('F', 'P') AND ms IS NOT NULL THEN 'closed' ELSE 'open' END AS state,
                     (o_orderstatus = 'F' AND ms IS NOT NULL) AS is_merged
              FROM shipped)""",
    "lines": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                     l_returnflag, l_linestatus) = 1""",
    "fi": """
        SELECT *, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS created_date_id,
               CAST(strftime(closed_at, '%Y%m%d') AS INTEGER) AS closed_date_id,
               epoch(closed_at - created_at) / 3600.0 AS time_to_close_hours
        FROM (SELECT l_orderkey * 10 + l_linenumber AS issue_id, l_orderkey % 25 + 1 AS repository_id,
                     o_custkey AS author_id, o_orderpriority, l_returnflag,
                     CASE l_linestatus WHEN 'O' THEN 'open' ELSE 'closed' END AS state,
                     o_orderdate AS created_at,
                     CASE WHEN l_linestatus <> 'O' THEN l_shipdate END AS closed_at
              FROM lines JOIN orders ON l_orderkey = o_orderkey)""",
    "rl": """
        SELECT l_suppkey % 25 + 1 AS repository_id, p_type AS language,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bytes
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "cal": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS full_date,
               CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
               dayname(d) AS day_name, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
               isodow(d) IN (6, 7) AS is_weekend
        FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)) AS d)""",
    # Silver records with references, some missing or unknown.
    "sc": """
        SELECT event_id, md5(CAST(event_id AS VARCHAR)) AS sha,
               CASE WHEN event_id % 97 = 0 THEN 'ghost/none' ELSE full_name END AS repository_full_name,
               CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'stranger'
                    ELSE 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END AS author_login,
               'Customer#' || lpad(CAST(user_id + 1 AS VARCHAR), 9, '0') AS committer_login, *
        FROM events JOIN repo ON repository_id = event_id % 25 + 1""",
    "sp": """
        SELECT o_orderkey AS github_pr_id,
               CASE WHEN o_orderkey % 97 = 0 THEN 'ghost/none' ELSE full_name END AS repository_full_name,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'stranger'
                    ELSE 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS author_login,
               o_orderdate, o_orderstatus, o_orderpriority, ms
        FROM shipped JOIN repo ON repository_id = o_orderkey % 25 + 1""",
    "si": """
        SELECT issue AS github_issue_id,
               CASE WHEN issue % 97 = 0 THEN 'ghost/none' ELSE full_name END AS repository_full_name,
               CASE WHEN issue % 11 = 0 THEN NULL WHEN issue % 13 = 0 THEN 'stranger'
                    ELSE 'Customer#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END AS author_login,
               CAST(l_shipdate AS DATE) - l_linenumber AS opened, l_shipdate, l_linestatus, l_returnflag
        FROM (SELECT *, l_orderkey * 10 + l_linenumber AS issue FROM lines)
        JOIN repo ON repository_id = issue % 25 + 1""",
}

_NEEDS = {
    "fp": ["shipped"], "fi": ["lines"], "sc": ["repo"], "sp": ["shipped", "repo"], "si": ["lines", "repo"],
}


def sql(tables: str, body: str) -> str:
    """``body`` with the named tables defined in front of it."""
    wanted: list[str] = []
    for name in tables.split():
        for needed in [*_NEEDS.get(name, []), name]:
            if needed not in wanted:
                wanted.append(needed)
    ctes = ", ".join(f"{name} AS ({TABLES[name]})" for name in wanted)
    return f"WITH {ctes} {body}" if ctes else body


def plain(df: DataFrame) -> DataFrame:
    """Time-zone-free timestamps, as the SQL side has them."""
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df


def flat(df: DataFrame) -> DataFrame:
    """Arrays as comma-separated text and maps as sorted ``key=value`` text."""
    texts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            texts[field.name] = F.array_join(field.name, ",")
        elif isinstance(field.dataType, T.MapType):
            pairs = F.transform(
                F.array_sort(F.map_entries(field.name)),
                lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
            )
            texts[field.name] = F.array_join(pairs, ",")
    return df.withColumns(texts) if texts else df


def iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%SZ')"
