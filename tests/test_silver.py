"""Cleaning: typing, deduplication, fills."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forgemart import schemas
from forgemart.bindings import bronze_records
from forgemart.operators import dedup
from forgemart.plans import silver


def commit(sha="s", repo="a/b", date="2024-01-01T10:00:00Z", day=1, **more):
    row = {f.name: None for f in schemas.bronze("commits")}
    return {**row, "sha": sha, "repository_full_name": repo, "author_date": date, **more,
            "year": 2024, "month": 1, "day": day}


def commits(spark, *rows):
    ddl = schemas.BRONZE_DDL["commits"] + ", year INT, month INT, day INT"
    return spark.createDataFrame(list(rows), schemas.struct(ddl))


def test_latest_snapshot_wins_and_fills(spark):
    out = silver.clean("commits", commits(spark, commit(day=1, message="old", additions=4), commit(day=2, message="new")))
    row, = out.collect()
    assert (row.message, row.additions, row.author_name, row.year, row.month) == ("new", 0, "Unknown", 2024, 1)


@pytest.mark.parametrize("bad", ["", "  ", "yesterday", None])
def test_a_copy_without_a_date_does_not_win(spark, bad):
    out = silver.clean("commits", commits(spark, commit(day=1, message="good"), commit(day=2, date=bad, message="bad")))
    assert [r.message for r in out.collect()] == ["good"]


def test_same_sha_in_two_repositories_stays(spark):
    out = silver.clean("commits", commits(spark, commit(repo="a/b"), commit(repo="a/c")))
    assert out.count() == 2


def test_null_keys_form_one_key(spark):
    out = silver.clean("commits", commits(spark, commit(sha=None, message="x"), commit(sha=None, message="y")))
    assert out.count() == 1


def test_durations(spark):
    ddl = schemas.BRONZE_DDL["pull_requests"]
    base = {f.name: None for f in schemas.bronze("pull_requests")}
    rows = [
        {**base, "id": 1, "created_at": "2024-01-01T00:00:00Z", "merged_at": "2024-01-01T01:30:00Z"},
        {**base, "id": 2, "created_at": "2024-01-01T00:00:00Z", "merged_at": ""},
    ]
    out = silver.clean("pull_requests", spark.createDataFrame(rows, schemas.struct(ddl))).orderBy("github_pr_id").collect()
    assert [(r.time_to_merge_hours, r.is_merged, r.draft) for r in out] == [(1.5, False, False), (None, False, False)]
    assert out[0].created_at == datetime(2024, 1, 1)


@pytest.mark.parametrize("entity", schemas.ENTITIES)
def test_result_does_not_depend_on_input_order(spark, sf_dir, entity):
    records = bronze_records(spark, sf_dir, entity)
    once = silver.clean(entity, records)
    again = silver.clean(entity, records.orderBy(F.rand(7)).repartition(5))
    if entity == "languages":  # maps do not compare
        once, again = (df.withColumn("languages", F.array_sort(F.map_entries("languages"))) for df in (once, again))
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()


@pytest.mark.parametrize("entity", schemas.ENTITIES)
def test_natural_keys_are_unique(spark, sf_dir, entity):
    cleaned = silver.clean(entity, bronze_records(spark, sf_dir, entity))
    assert cleaned.groupBy(*schemas.KEYS[entity]).count().filter("count > 1").isEmpty()
    typed = [(f.name, f.dataType) for f in cleaned.schema][: len(schemas.silver(entity))]
    assert typed == [(f.name, f.dataType) for f in schemas.silver(entity)]


def test_copies_of_one_hot_key_are_cut_before_the_shuffle(spark):
    """A third of all rows share a key; each task ships one of them."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), F.col("id").alias("version"))
    kept = dedup.latest_by_key(rows, ["key"], [F.col("version").desc()])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_shuffle and ", Partial" in below_shuffle
    assert kept.count() == 20_001 and kept.filter("key = 0").first().version == 29_997


def test_large_caps_are_exact(spark):
    random.seed(3)
    rows = [("hot" if i % 3 else f"k{i % 50}", random.randrange(10**6), i) for i in range(9000)]
    df = spark.createDataFrame(rows, "key string, rank long, id long")
    kept = dedup.cap_per_key(df, ["key"], [F.col("rank").desc()], 1200).filter("key = 'hot'")
    expected = sorted(((-r, i) for k, r, i in rows if k == "hot"))[:1200]
    assert sorted((-r.rank, r.id) for r in kept.collect()) == expected
