"""Dimensions, keys, facts."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from forgemart import bindings, schemas
from forgemart.checks import loads
from forgemart.checks.loads import _silver_layers
from forgemart.operators import keys
from forgemart.plans import star


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    return star.build_star(spark, _silver_layers(spark, sf_dir), include_pr_issue_authors=True)


def test_default_calendar(spark):
    calendar = star.dim_date(spark)
    assert calendar.count() == 4018
    row = calendar.filter("date_id = 20210101").first()
    assert (row.week, row.quarter, row.day_of_week, row.day_name, row.is_weekend) == (53, 1, 4, "Friday", False)
    assert star.dim_date(spark, padded_names=True).first().month_name == "January  "
    with pytest.raises(ValueError):
        star.dim_date(spark, date(2024, 1, 2), date(2024, 1, 1))


def test_extending_the_calendar_twice_changes_nothing(spark):
    base = star.dim_date(spark, date(2024, 1, 1), date(2024, 1, 31))
    once = star.extend_calendar(base, spark, date(2024, 1, 15), date(2024, 2, 10))
    assert once.count() == 41
    assert star.extend_calendar(once, spark, date(2024, 1, 15), date(2024, 2, 10)).count() == 41


def test_tables_follow_their_contract(built):
    for name, table in built.tables().items():
        found = {f.name: f.dataType for f in table.schema}
        expected = {f.name: f.dataType for f in schemas.gold(name)}
        assert found == expected, name


def test_keys_are_unique_in_every_table(built):
    for name, table in built.tables().items():
        for key in schemas.UNIQUE[name]:
            present = table.dropna(subset=key)
            assert present.count() == present.select(*key).distinct().count(), (name, key)


def test_keys_do_not_depend_on_order_or_partitions(spark, sf_dir):
    users = bindings.users(spark, sf_dir).drop("user_id")
    one = keys.numbered(users, "login", "k").select("login", "k")
    two = keys.numbered(users.orderBy(F.rand(1)).repartition(7), "login", "k").select("login", "k")
    assert one.exceptAll(two).isEmpty()


def test_many_rows_get_distinct_keys(spark):
    keyed = keys.numbered(spark.range(200_000).select(F.col("id").cast("string").alias("n")), "n", "k")
    row = keyed.agg(F.count_distinct("k").alias("n"), F.min("k").alias("low")).first()
    assert row.n == 200_000 and row.low > 0


def test_reloading_keeps_keys_and_adds_new_ones(spark):
    first = keys.numbered(spark.createDataFrame([("a",), ("b",)], "login string"), "login", "user_id")
    second = keys.with_kept_keys(first, spark.createDataFrame([("b",), ("c",), ("d",)], "login string"), "login", "user_id")
    old, new = ({r.login: r.user_id for r in df.collect()} for df in (first, second))
    assert new["b"] == old["b"] and len(set(new.values())) == 3
    assert min(new["c"], new["d"]) > max(old.values())


def test_user_with_id_wins_and_blank_logins_go(spark):
    ddl = "github_user_id long, login string, avatar_url string, user_type string, html_url string"
    known = spark.createDataFrame([(7, "ann", "img", "Bot", None), (8, None, None, "User", None)], ddl)
    records = spark.createDataFrame([("ann",), ("bob",), ("bob",), (None,)], "author_login string")
    out = star.dim_user([star.author_users(records), star.contributor_users(known)]).orderBy("login").collect()
    assert [(r.login, r.github_user_id, r.user_type) for r in out] == [("ann", 7, "Bot"), ("bob", None, "User")]


def test_pr_authors_join_the_users_only_on_request(spark, sf_dir):
    layers = _silver_layers(spark, sf_dir)
    narrow = star.build_star(spark, layers)
    wide = star.build_star(spark, layers, include_pr_issue_authors=True)
    assert wide.user.count() > narrow.user.count()
    assert wide.prs.filter("author_id IS NULL").count() < narrow.prs.filter("author_id IS NULL").count()


def test_shared_repository_name_does_not_double_facts(spark):
    repo = spark.createDataFrame(
        [(1, "a/b", date(2020, 1, 1)), (2, "a/b", date(2022, 1, 1)), (3, "a/c", None)],
        "repository_id long, full_name string, created_at date")
    user = spark.createDataFrame([], "user_id long, login string")
    records = spark.createDataFrame([("x", "a/b", None), ("y", "a/c", "z"), ("w", "no/ne", None)],
                                    "sha string, repository_full_name string, author_login string")
    out = star.resolve_keys(records, repo, user).orderBy("sha").collect()
    assert [(r.sha, r.repository_id, r.author_id) for r in out] == [("w", None, None), ("x", 2, None), ("y", 3, None)]


def test_language_shares_guard_against_zero(spark):
    maps = spark.createDataFrame([("a/b", {"Go": 0, "C": None}, 0), ("a/c", {}, 0)],
                                 "repository_full_name string, languages map<string,bigint>, total_bytes bigint")
    assert [(r.language, r.percentage) for r in star.language_shares(maps).collect()] == [("Go", 0.0)]


def test_hot_and_missing_logins_are_split(spark):
    """Half the rows have no login and a third share one; the join splits their partitions."""
    old = {k: spark.conf.get(k, None) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "60KB")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        i = F.col("id")
        login = F.when(i % 6 < 3, None).when(i % 6 < 5, F.lit("bot")).otherwise(F.concat(F.lit("u"), (i % 5000).cast("string")))
        facts = spark.range(0, 300_000, 1, 12).select(i, login.alias("author_login"))
        users = spark.range(5000).select(
            (i + 1).alias("user_id"), F.when(i == 0, "bot").otherwise(F.concat(F.lit("u"), i.cast("string"))).alias("login"))
        joined = keys.lookup(facts, users, "login", "author_login", "user_id", "author_id")
        rows = joined.collect()
        assert len(rows) == 300_000 and sum(r.author_id == 1 for r in rows) == 100_000
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_check_loads_read_stored_silver_tables(spark, sf_dir):
    made, stored = bindings.silver_tables(spark, sf_dir), loads.stored_silver(spark, sf_dir)
    assert {e: df.schema.simpleString() for e, df in stored.items()} == {e: df.schema.simpleString() for e, df in made.items()}
    assert not any(sf_dir in name for df in stored.values() for name in df.inputFiles())
    assert {e: df.count() for e, df in stored.items()} == {e: df.count() for e, df in made.items()}
