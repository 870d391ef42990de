"""The retail test tables seen as software-development activity.

``bind`` gives a star schema; ``bronze_records`` and ``raw_payloads`` give what the earlier layers read. Every
frame covers the whole of the tables it is made from.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemart import schemas
from forgemart.functions import numbers, times
from forgemart.operators.dedup import latest_by_key
from forgemart.plans.star import Star, dim_date

AS_OF = date(2024, 1, 30)
_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
_MISSING = "ghost/none"


TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; the schema is given, so opening it runs no job."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _iso(ts: Column) -> Column:
    return F.date_format(ts, _ISO)


def _nth(column: str, n: int) -> Column:
    """True for one row in ``n``; used to sprinkle in blanks, nulls and strangers."""
    return F.col(column) % n == 0


def repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = (table(spark, sf_dir, name) for name in ("nation", "region"))
    key = F.col("n_nationkey")
    language = F.when(key % 5 == 0, "Python").when(key % 5 == 1, "Go").when(key % 5 == 2, "Rust").when(
        key % 5 == 3, "Java"
    )
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (key + 1).cast("bigint").alias("repository_id"),
        (key + 1000).cast("bigint").alias("github_repo_id"),
        F.concat("r_name", F.lit("/"), "n_name").alias("full_name"),
        F.col("r_name").alias("owner"),
        F.col("n_name").alias("name"),
        F.lit(None).cast("string").alias("description"),
        language.alias("language"),
        ((key * 37) % 101).cast("int").alias("stars_count"),
        ((key * 13) % 17).cast("int").alias("forks_count"),
        (key % 3 == 0).alias("is_fork"),
        F.date_add(F.lit(date(2019, 6, 1)), key).cast("timestamp").alias("created_at"),
        F.concat(F.lit("https://code.example/"), "r_name", F.lit("/"), "n_name").alias("html_url"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    avatar = F.when(~_nth("c_custkey", 7), F.concat(F.lit("https://img.example/"), F.col("c_custkey").cast("string")))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("login"), avatar.alias("avatar_url")
    )


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    authored = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("commit_id"),
        (F.col("event_id") % 25 + 1).alias("repository_id"),
        F.col("user_id").alias("author_id"),
        times.date_id(authored).alias("date_id"),
        F.floor(F.col("value") * 10).cast("int").alias("additions"),
        F.floor("value").cast("int").alias("deletions"),
        authored.alias("authored_at"),
    )


def _orders_with_last_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("ms"))
    return table(spark, sf_dir, "orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")


def pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, shipped = F.col("o_orderstatus"), F.col("ms").cast("timestamp")
    merged, done = status == "F", status.isin("F", "P")
    created = F.col("o_orderdate").cast("timestamp")
    return (
        _orders_with_last_shipment(spark, sf_dir)
        .select(
            F.col("o_orderkey").alias("pr_id"),
            (F.col("o_orderkey") % 25 + 1).alias("repository_id"),
            F.col("o_custkey").alias("author_id"),
            F.when(done & shipped.isNotNull(), "closed").otherwise("open").alias("state"),
            (merged & shipped.isNotNull()).alias("is_merged"),
            created.alias("created_at"),
            F.when(merged, shipped).alias("merged_at"),
            F.when(done, shipped).alias("closed_at"),
        )
        .withColumns(
            {
                "created_date_id": times.date_id(F.col("created_at")),
                "merged_date_id": times.date_id(F.col("merged_at")),
                "closed_date_id": times.date_id(F.col("closed_at")),
                "time_to_merge_hours": times.hours_between(F.col("created_at"), F.col("merged_at")),
            }
        )
    )


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = latest_by_key(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()]
    )
    is_open = F.col("l_linestatus") == "O"
    return (
        lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("issue_id"),
            (F.col("l_orderkey") % 25 + 1).alias("repository_id"),
            F.col("o_custkey").alias("author_id"),
            F.when(is_open, "open").otherwise("closed").alias("state"),
            F.array("o_orderpriority", "l_returnflag").alias("labels"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
            F.when(~is_open, F.col("l_shipdate").cast("timestamp")).alias("closed_at"),
        )
        .withColumns(
            {
                "created_date_id": times.date_id(F.col("created_at")),
                "closed_date_id": times.date_id(F.col("closed_at")),
                "time_to_close_hours": times.hours_between(F.col("created_at"), F.col("closed_at")),
            }
        )
    )


def repo_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes per supplier-as-repository and part type."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return lines.groupBy((F.col("l_suppkey") % 25 + 1).alias("repository_id"), F.col("p_type").alias("language")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("bytes")
    )


class BoundStar(Star):
    """A star whose tables are opened when a query first asks for them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        object.__setattr__(self, "_source", (spark, sf_dir))

    repo = cached_property(lambda self: repositories(*self._source))
    user = cached_property(lambda self: users(*self._source))
    date = cached_property(lambda self: dim_date(self._source[0], date(1995, 1, 1), date(2030, 12, 31)))
    commits = cached_property(lambda self: commits(*self._source))
    prs = cached_property(lambda self: pull_requests(*self._source))
    issues = cached_property(lambda self: issues(*self._source))
    languages = cached_property(lambda self: repo_bytes(*self._source))


def bind(spark: SparkSession, sf_dir: str) -> Star:
    return BoundStar(spark, sf_dir)


# --- Raw payloads -----------------------------------------------------------------------------------------


def _as_json(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows as JSON texts; null fields are left out, so a null column is an absent key."""
    fields = [c for c in df.columns if c not in keep]
    return df.select(F.to_json(F.struct(*fields)).alias("payload"), *keep)


def _login(name: Column) -> Column:
    return F.when(name.isNotNull(), F.struct(name.alias("login")))


def raw_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("id"),
        F.concat("c_mktsegment", F.lit("/"), "c_name").alias("full_name"),
        F.col("c_name").alias("name"),
        F.struct(F.col("c_mktsegment").alias("login")).alias("owner"),
        F.when(~_nth("c_custkey", 3), F.lit("a repository")).alias("description"),
        F.when(~_nth("c_custkey", 5), F.lit("trunk")).alias("default_branch"),
        F.when(~_nth("c_custkey", 2), F.lit(True)).alias("private"),
        F.when(~_nth("c_custkey", 4), (key % 1000).cast("int")).alias("stargazers_count"),
        F.col("c_nationkey").alias("size"),
        F.when(~_nth("c_custkey", 6), F.array("c_mktsegment", F.lit("x"))).alias("topics"),
        F.when(~_nth("c_custkey", 4), F.struct(F.lit("MIT").alias("spdx_id"))).alias("license"),
    )


def _raw_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    def person(n: int) -> Column:
        return F.struct(
            F.when(~_nth("event_id", n), F.col("event_type")).alias("name"),
            F.concat(F.col("user_id").cast("string"), F.lit("@mail.example")).alias("email"),
            F.when(~_nth("event_id", 9), _iso(F.col("ts"))).alias("date"),
        )

    lines = F.floor("value").cast("int")
    stats = F.struct(lines.alias("additions"), (lines * 2).alias("deletions"), (lines * 3).alias("total"))
    return table(spark, sf_dir, "events").select(
        F.md5(F.col("event_id").cast("string")).alias("sha"),
        F.struct(person(5).alias("author"), person(7).alias("committer"), F.col("props").alias("message")).alias("commit"),
        _login(F.when(~_nth("event_id", 4), F.col("user_id").cast("string"))).alias("author"),
        F.when(~_nth("event_id", 6), stats).alias("stats"),
        F.concat(F.lit("org/repo"), (F.col("event_id") % 25).cast("string")).alias("repository_full_name"),
    )


def _raw_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_last_shipment(spark, sf_dir).select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderkey") % 1000).cast("int").alias("number"),
        F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
        _login(F.when(~_nth("o_orderkey", 8), F.col("o_custkey").cast("string"))).alias("user"),
        _iso(F.col("o_orderdate")).alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", _iso(F.col("ms"))).alias("merged_at"),
        F.when(~_nth("o_orderkey", 3), (F.col("o_custkey") % 50).cast("int")).alias("comments"),
        F.array(
            F.struct(F.col("o_orderpriority").alias("name")),
            F.struct(F.when(~_nth("o_orderkey", 2), F.col("o_orderstatus")).alias("name")),
        ).alias("labels"),
        F.when(_nth("o_orderkey", 10), F.lit(True)).alias("draft"),
        F.concat(F.lit("org/repo"), (F.col("o_orderkey") % 25).cast("string")).alias("repository_full_name"),
    )


def _raw_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderkey") % 1000).cast("int").alias("number"),
        F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
        _login(F.col("o_custkey").cast("string")).alias("user"),
        _iso(F.col("o_orderdate")).alias("created_at"),
        F.array(F.struct(F.col("o_orderpriority").alias("name"))).alias("labels"),
        F.when(~_nth("o_orderkey", 3), F.array(F.struct(F.col("o_custkey").cast("string").alias("login")))).alias("assignees"),
        F.when(~_nth("o_orderkey", 4), F.struct(F.col("o_orderstatus").alias("title"))).alias("milestone"),
        F.when(_nth("o_orderkey", 5), F.struct(F.lit("https://code.example").alias("url"))).alias("pull_request"),
        F.concat(F.lit("org/repo"), (F.col("o_orderkey") % 25).cast("string")).alias("repository_full_name"),
    )


def _raw_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("login"),
        F.when(~_nth("c_custkey", 3), F.col("c_nationkey")).alias("contributions"),
        F.when(_nth("c_custkey", 10), F.lit("Bot")).alias("type"),
        F.concat(F.lit("org/repo"), F.col("c_nationkey").cast("string")).alias("repository_full_name"),
    )


def language_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per supplier-as-repository a map of part type to bytes; the entries per map are the part types."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    sizes = lines.groupBy("l_suppkey", "p_type").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("bytes"))
    entries = F.map_from_entries(F.collect_list(F.struct("p_type", "bytes")))
    return sizes.groupBy("l_suppkey").agg(entries.alias("languages")).select(
        F.concat(F.lit("org/repo"), F.col("l_suppkey").cast("string")).alias("repository_full_name"), "languages"
    )


def raw_payloads(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """JSON texts as the API would send them, in ``payload``."""
    raw = {
        "repositories": raw_repositories,
        "commits": _raw_commits,
        "pull_requests": _raw_pull_requests,
        "issues": _raw_issues,
        "contributors": _raw_contributors,
        "languages": language_maps,
    }[entity]
    return _as_json(raw(spark, sf_dir))


# --- Bronze records ---------------------------------------------------------------------------------------


def _snapshots(df: DataFrame, days: int = 2) -> DataFrame:
    """The same records landed on several days, as the lake holds them."""
    return df.withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(days)))).withColumns(
        {"year": F.lit(2024), "month": F.lit(2)}
    )


def _bronze_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    stars = F.when(~_nth("c_custkey", 4), (key % 1000 + F.col("day")).cast("int"))
    return _snapshots(table(spark, sf_dir, "customer")).select(
        key.alias("id"),
        F.concat("c_mktsegment", F.lit("/"), "c_name").alias("full_name"),
        F.col("c_mktsegment").alias("owner"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("description"),
        F.when(~_nth("c_custkey", 3), F.lit("Go")).alias("language"),
        F.lit("main").alias("default_branch"),
        F.lit(False).alias("is_private"),
        _nth("c_custkey", 2).alias("is_fork"),
        stars.alias("stars_count"),
        F.col("c_nationkey").alias("forks_count"),
        F.lit(None).cast("int").alias("watchers_count"),
        F.lit(None).cast("int").alias("open_issues_count"),
        F.lit(None).cast("int").alias("size_kb"),
        F.lit(None).cast("string").alias("license_name"),
        F.lit("").alias("html_url"),
        F.when(_nth("c_custkey", 5), F.lit("")).otherwise(F.lit("2021-03-04T05:06:07Z")).alias("created_at"),
        F.format_string("2024-02-%02dT00:00:00Z", "day").alias("updated_at"),
        "year", "month", "day",
    )


def _bronze_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The second day's copy of some commits lost its date: the first day's must then survive.
    authored = (
        F.when(_nth("event_id", 17) & (F.col("day") == 2), F.lit(""))
        .when(_nth("event_id", 19), F.lit("not a date"))
        .otherwise(_iso(F.col("ts")))
    )
    lines = F.when(~_nth("event_id", 6), F.floor("value").cast("int"))
    return _snapshots(table(spark, sf_dir, "events")).select(
        F.md5(F.col("event_id").cast("string")).alias("sha"),
        F.concat(F.lit("org/repo"), (F.col("event_id") % 25).cast("string")).alias("repository_full_name"),
        F.when(~_nth("event_id", 4), F.col("user_id").cast("string")).alias("author_login"),
        F.when(~_nth("event_id", 5), F.col("event_type")).alias("author_name"),
        F.lit("").alias("author_email"),
        authored.alias("author_date"),
        F.lit(None).cast("string").alias("committer_login"),
        F.lit(None).cast("string").alias("committer_name"),
        F.lit(None).cast("string").alias("committer_date"),
        F.concat(F.lit("seen on day "), F.col("day").cast("string")).alias("message"),
        lines.alias("additions"),
        lines.alias("deletions"),
        lines.alias("files_changed"),
        "year", "month", "day",
    )


def _bronze_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = F.col("o_orderstatus") == "F"
    none = F.lit(None).cast("int")
    return _snapshots(_orders_with_last_shipment(spark, sf_dir)).select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderkey") % 1000).cast("int").alias("number"),
        F.concat(F.lit("org/repo"), (F.col("o_orderkey") % 25).cast("string")).alias("repository_full_name"),
        F.col("o_orderpriority").alias("title"),
        # Open on the first day, as ordered on the second.
        F.when((F.col("day") == 1) | (F.col("o_orderstatus") == "O"), "open").otherwise("closed").alias("state"),
        F.col("o_custkey").cast("string").alias("author_login"),
        F.lit(None).cast("boolean").alias("draft"),
        F.when(F.col("day") == 2, merged).alias("is_merged"),
        (F.col("o_custkey") % 50).cast("int").alias("comments_count"),
        none.alias("review_comments_count"),
        none.alias("commits_count"),
        none.alias("additions"),
        none.alias("deletions"),
        none.alias("changed_files"),
        F.when(~_nth("o_orderkey", 23), _iso(F.col("o_orderdate"))).alias("created_at"),
        F.format_string("2024-02-%02dT00:00:00Z", "day").alias("updated_at"),
        F.when(F.col("o_orderstatus") != "O", _iso(F.col("ms"))).alias("closed_at"),
        F.when(merged & (F.col("day") == 2), _iso(F.col("ms"))).alias("merged_at"),
        "year", "month", "day",
    )


def _bronze_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as issues: a third of the rows are surplus copies of an (order, line) key."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_linenumber").alias("number"),
        F.concat(F.lit("org/repo"), (F.col("l_orderkey") % 25).cast("string")).alias("repository_full_name"),
        F.col("l_returnflag").alias("title"),
        F.when(F.col("l_linestatus") == "O", "open").otherwise("closed").alias("state"),
        F.col("l_suppkey").cast("string").alias("author_login"),
        F.when(~_nth("l_suppkey", 3), F.col("l_quantity").cast("int")).alias("comments_count"),
        F.array("l_returnflag", "l_linestatus").alias("labels"),
        F.array(F.col("l_suppkey").cast("string")).alias("assignees"),
        F.lit(None).cast("string").alias("milestone"),
        F.when(~_nth("l_partkey", 29), _iso(F.date_sub(F.col("l_shipdate"), F.col("l_linenumber")))).alias("created_at"),
        _iso(F.col("l_shipdate")).alias("updated_at"),
        F.when(F.col("l_linestatus") == "F", _iso(F.col("l_shipdate"))).alias("closed_at"),
    )


def _bronze_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    contributions = F.when(~_nth("c_custkey", 3), (F.col("c_nationkey") + F.col("day")).cast("int"))
    return _snapshots(table(spark, sf_dir, "customer")).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("login"),
        F.concat(F.lit("org/repo"), F.col("c_nationkey").cast("string")).alias("repository_full_name"),
        contributions.alias("contributions"),
        F.lit(None).cast("string").alias("avatar_url"),
        F.when(_nth("c_custkey", 10), F.lit("Bot")).alias("type"),
        F.lit(None).cast("string").alias("html_url"),
        "year", "month", "day",
    )


def _bronze_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = language_maps(spark, sf_dir)
    total = F.aggregate(F.map_values("languages"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return _snapshots(maps).select(
        "repository_full_name", "languages", (total + F.col("day")).alias("total_bytes"), "year", "month", "day"
    )


def bronze_records(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Records as landed: repeated daily, with blanks, nulls and unreadable dates among them."""
    return {
        "repositories": _bronze_repositories,
        "commits": _bronze_commits,
        "pull_requests": _bronze_pull_requests,
        "issues": _bronze_issues,
        "contributors": _bronze_contributors,
        "languages": _bronze_languages,
    }[entity](spark, sf_dir)


# --- Silver records whose references need resolving -------------------------------------------------------


def _references(df: DataFrame, repo: DataFrame, key: str, user: str) -> DataFrame:
    """Add repository names and author logins, some of them missing or unknown."""
    names = repo.select((F.col("repository_id") - 1).alias("_n"), F.col("full_name").alias("_name"))
    login = F.concat(F.lit("Customer#"), F.lpad(F.col(user).cast("string"), 9, "0"))
    return (
        df.join(names, F.col(key) % 25 == F.col("_n"))
        .withColumns(
            {
                "repository_full_name": F.when(_nth(key, 97), F.lit(_MISSING)).otherwise(F.col("_name")),
                "author_login": F.when(_nth(key, 11), F.lit(None))
                .when(_nth(key, 13), F.lit("stranger"))
                .otherwise(login),
            }
        )
        .drop("_n", "_name")
    )


def silver_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commit_records(table(spark, sf_dir, "events"), repositories(spark, sf_dir))


def commit_records(events: DataFrame, repo: DataFrame) -> DataFrame:
    named = _references(events, repo, "event_id", "user_id")
    committer = F.concat(F.lit("Customer#"), F.lpad(((F.col("user_id") + 1)).cast("string"), 9, "0"))
    return named.select(
        F.md5(F.col("event_id").cast("string")).alias("sha"),
        "repository_full_name",
        "author_login",
        committer.alias("committer_login"),
        F.col("ts").cast("timestamp").alias("author_date"),
        F.col("event_type").alias("message"),
        F.floor(F.col("value") * 10).cast("int").alias("additions"),
        F.floor("value").cast("int").alias("deletions"),
        F.lit(1).alias("files_changed"),
    )


def silver_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _references(
        _orders_with_last_shipment(spark, sf_dir), repositories(spark, sf_dir), "o_orderkey", "o_custkey"
    )
    merged = F.when(F.col("o_orderstatus") == "F", F.col("ms").cast("timestamp"))
    zero = F.lit(0)
    return named.select(
        F.col("o_orderkey").alias("github_pr_id"),
        (F.col("o_orderkey") % 1000).cast("int").alias("number"),
        "repository_full_name",
        "author_login",
        F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
        F.lit(False).alias("draft"),
        merged.isNotNull().alias("is_merged"),
        *[zero.alias(c) for c in (
            "comments_count", "review_comments_count", "commits_count", "additions", "deletions", "changed_files"
        )],
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        merged.alias("merged_at"),
        F.when(F.col("o_orderstatus") != "O", F.col("ms").cast("timestamp")).alias("closed_at"),
    ).withColumn("time_to_merge_hours", times.hours_between(F.col("created_at"), F.col("merged_at")))


def silver_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = latest_by_key(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()]
    ).withColumn("issue", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    named = _references(lines, repositories(spark, sf_dir), "issue", "l_suppkey")
    closed = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate").cast("timestamp"))
    return named.select(
        F.col("issue").alias("github_issue_id"),
        F.col("l_linenumber").alias("number"),
        "repository_full_name",
        "author_login",
        F.col("l_returnflag").alias("title"),
        F.when(F.col("l_linestatus") == "O", "open").otherwise("closed").alias("state"),
        F.lit(0).alias("comments_count"),
        F.array("l_returnflag").alias("labels"),
        F.array(F.col("l_suppkey").cast("string")).alias("assignees"),
        F.lit(None).cast("string").alias("milestone"),
        F.date_sub(F.col("l_shipdate"), F.col("l_linenumber")).cast("timestamp").alias("created_at"),
        closed.alias("closed_at"),
    ).withColumn("time_to_close_hours", times.hours_between(F.col("created_at"), F.col("closed_at")))


def silver_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = repositories(spark, sf_dir)
    return known.select(
        *[
            (F.col(f.name) if f.name in known.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.silver("repositories")
        ]
    )


def silver_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir).select(
        F.col("user_id").alias("github_user_id"),
        "login",
        F.lit(_MISSING).alias("repository_full_name"),
        F.lit(1).alias("contributions"),
        "avatar_url",
        F.lit("User").alias("user_type"),
        F.lit(None).cast("string").alias("html_url"),
    )


def silver_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One map per repository; the entries per map are the part types."""
    entries = F.map_from_entries(F.collect_list(F.struct("language", "bytes")))
    maps = repo_bytes(spark, sf_dir).groupBy("repository_id").agg(entries.alias("languages"))
    names = repositories(spark, sf_dir).select("repository_id", F.col("full_name").alias("repository_full_name"))
    return maps.join(names, "repository_id").select(
        "repository_full_name", "languages", numbers.map_total(F.col("languages")).alias("total_bytes")
    )


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Silver tables that belong together: most facts refer to repositories and users that exist."""
    return {
        "repositories": silver_repositories(spark, sf_dir),
        "commits": silver_commits(spark, sf_dir),
        "pull_requests": silver_pull_requests(spark, sf_dir),
        "issues": silver_issues(spark, sf_dir),
        "contributors": silver_contributors(spark, sf_dir),
        "languages": silver_languages(spark, sf_dir),
    }
