"""Lake files: formats, missing parts, pruning, observed counts, partition upserts, JDBC options."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from forgemart.operators import quality
from forgemart.session import scratch_path
from forgemart.sources import jdbc, lake


def land(root, entity, day, name, document):
    folder = root / "bronze" / entity / "year=2024" / "month=01" / f"day={day:02d}"
    folder.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=2)
    (folder / f"{name}.json").write_text(text)


def contributor(i):
    return {"id": i, "login": f"u{i}", "repository_full_name": "a/b"}


def test_whole_document_files_hold_objects_or_arrays(spark, tmp_path):
    land(tmp_path, "contributors", 1, "a_b", [contributor(1), contributor(2)])
    land(tmp_path, "contributors", 2, "a_c", contributor(3))
    land(tmp_path, "contributors", 3, "a_d", [])
    df = lake.read_bronze(spark, lake.LakePaths(str(tmp_path)), "contributors", multi_line=True)
    assert sorted((r.id, r.year, r.month, r.day) for r in df.collect()) == [(1, 2024, 1, 1), (2, 2024, 1, 1), (3, 2024, 1, 2)]


def test_broken_documents_are_kept_apart(spark, tmp_path):
    land(tmp_path, "contributors", 1, "good", [contributor(1)])
    land(tmp_path, "contributors", 1, "bad", "{nope")
    df = lake.read_bronze(spark, lake.LakePaths(str(tmp_path)), "contributors", multi_line=True)
    assert sorted((r.id, r._corrupt_record is None) for r in df.fillna(-1, ["id"]).collect()) == [(-1, False), (1, True)]


def test_missing_and_empty_entities_are_skipped(spark, tmp_path):
    paths = lake.LakePaths(str(tmp_path))
    assert lake.read_bronze(spark, paths, "issues") is None
    assert lake.read_silver(spark, paths, "issues") is None
    (tmp_path / "bronze" / "issues").mkdir(parents=True)
    assert lake.read_bronze(spark, paths, "issues") is None
    land(tmp_path, "issues", 1, "a_b", [])
    assert lake.read_bronze(spark, paths, "issues", multi_line=True) is None


def test_unreadable_silver_raises(spark, tmp_path):
    folder = tmp_path / "silver" / "issues"
    folder.mkdir(parents=True)
    (folder / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        lake.read_silver(spark, lake.LakePaths(str(tmp_path)), "issues").count()


def test_landed_days_prune_partitions(spark, tmp_path):
    for day in (1, 2, 3):
        land(tmp_path, "contributors", day, "a_b", json.dumps(contributor(day)))
    df = lake.read_bronze(spark, lake.LakePaths(str(tmp_path)), "contributors", since=date(2024, 1, 2))
    assert sorted(r.id for r in df.collect()) == [2, 3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_writing_counts_rows_in_the_same_pass(spark, tmp_path):
    paths = lake.LakePaths(str(tmp_path))
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("month"))
    seen = lake.write_silver(df, paths, "t", ["month"])
    assert seen.get["rows"] == 100 and lake.read_silver(spark, paths, "t").count() == 100


def test_small_partitions_get_few_files(spark, tmp_path):
    paths = lake.LakePaths(str(tmp_path))
    df = spark.range(0, 4000, 1, 16).select("id", (F.col("id") % 12).cast("int").alias("month"))
    lake.write_silver(df, paths, "t", ["month"])
    assert len(list((tmp_path / "silver" / "t").rglob("*.parquet"))) <= 24


def test_upsert_moves_rows_and_removes_emptied_partitions(spark, tmp_path):
    paths = lake.LakePaths(str(tmp_path))
    ddl = "id int, v string, year int, month int"
    old = spark.createDataFrame([(1, "a", 2024, 1), (2, "b", 2024, 2), (3, "c", 2024, 3)], ddl)
    delta = spark.createDataFrame([(1, "A", 2024, 2), (4, "d", 2024, 4)], ddl)
    args = (["id"], ["year", "month"])
    lake.upsert_silver(spark, paths, "t", old, *args)
    untouched = {p.name for p in (tmp_path / "silver/t/year=2024/month=3").glob("*.parquet")}
    for _ in range(2):  # the second run changes nothing
        lake.upsert_silver(spark, paths, "t", delta, *args)
        found = sorted((r.id, r.v, r.month) for r in lake.read_silver(spark, paths, "t").collect())
        assert found == [(1, "A", 2), (2, "b", 2), (3, "c", 3), (4, "d", 4)]
    assert not (tmp_path / "silver/t/year=2024/month=1").exists()
    assert {p.name for p in (tmp_path / "silver/t/year=2024/month=3").glob("*.parquet")} == untouched


def test_null_keys_are_replaced_and_null_partitions_refused(spark, tmp_path):
    paths = lake.LakePaths(str(tmp_path))
    ddl = "id int, v string, year int"
    old = spark.createDataFrame([(None, "a", 2024), (2, "b", 2024)], ddl)
    lake.upsert_silver(spark, paths, "t", old, ["id"], ["year"])
    lake.upsert_silver(spark, paths, "t", spark.createDataFrame([(None, "A", 2024)], ddl), ["id"], ["year"])
    found = sorted((r.id or 0, r.v) for r in lake.read_silver(spark, paths, "t").collect())
    assert found == [(0, "A"), (2, "b")]
    with pytest.raises(Exception, match="year is null"):
        lake.upsert_silver(spark, paths, "t", spark.createDataFrame([(3, "c", None)], ddl), ["id"], ["year"])


def test_scratch_paths_are_new_and_shared(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_validation_gives_every_reason(spark):
    df = spark.createDataFrame([(1, 5, 3), (2, None, 3), (3, 1, None)], "id int, a int, b int")
    good, bad = quality.validate(df, [("a above b", F.col("a") > F.col("b")), ("no b", F.col("b").isNull())])
    assert [r.id for r in good.collect()] == [2]
    assert sorted((r.id, r.reasons) for r in bad.collect()) == [(1, ["a above b"]), (3, ["no b"])]
    assert {r.reason: r.n_rows for r in quality.reject_counts(bad).collect()} == {"a above b": 1, "no b": 1}


def test_quality_checks_on_edges(spark):
    df = spark.createDataFrame([("x", "ab"), ("x", None), (None, "abc"), (None, "q")], "k string, v string")
    assert [(r.k, r.n_rows) for r in quality.unique_violations(df, ["k"]).collect()] == [("x", 2)]
    assert {r.column_name: r.n_nulls for r in quality.null_counts(df, ["k", "v"]).collect()} == {"k": 2, "v": 1}
    assert [r.v for r in quality.not_in_set(df, "v", ["ab", "q"]).collect()] == ["abc"]
    assert [(r.v, r.too_long) for r in quality.too_long(df, {"v": 2}).collect()] == [("abc", ["v"])]
    dim = spark.createDataFrame([("x",)], "id string")
    assert quality.orphans(df, "k", dim, "id").isEmpty()


def test_jdbc_options():
    options = jdbc.read_options("jdbc:x", "t", {"user": "u"}, ("id", 0, 99, 4))
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "0", "99", "4")
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "t", {})
    assert jdbc.write_options("jdbc:x", "t", {"driver": "d"}, connections=3)["numPartitions"] == "3"
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "t", {}, ("id", 5, 1, 4))


def test_bronze_is_compressed_in_files_of_bounded_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lake, "RECORDS_PER_FILE", 10)
    paths = lake.LakePaths(str(tmp_path))
    records = spark.createDataFrame([contributor(i) for i in range(95)], "id long, login string, repository_full_name string")
    assert lake.write_bronze(records.coalesce(1), paths, "contributors", date(2024, 1, 1)).get["rows"] == 95
    files = sorted(p.name for p in (tmp_path / "bronze" / "contributors").rglob("part-*"))
    assert len(files) == 10 and all(name.endswith(".json.gz") for name in files)
    assert sorted(r.id for r in lake.read_bronze(spark, paths, "contributors").collect()) == list(range(95))
