"""Versioned tables: what readers see, what is read and rewritten, order of arrival, cleaning up."""

import itertools

import pytest
from pyspark.sql import functions as F

from forgemart.sources import lake, versions

DDL = "id int, v string, at int, year int, month int"
PARTS = ["year", "month"]


def rows(spark, *values):
    return spark.createDataFrame([(*v, 2024, m) for *v, m in values], DDL)


def found(df):
    return sorted((r.id, r.v, r.month) for r in df.collect())


def scanned_files(df):
    """Files that the scans of an executed plan have read."""
    df.collect()
    total, waiting = 0, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            waiting.append(node.plan())
            continue
        if name == "FileSourceScanExec" and "/data" in node.relation().location().rootPaths().mkString():
            total += node.metrics().apply("numFiles").value()
        children = node.children()
        waiting += [children.apply(k) for k in range(children.size())]
    return total


def test_readers_keep_the_version_they_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.current(spark, path) is None
    assert versions.replace(spark, path, rows(spark, (1, "a", 1, 1), (2, "b", 1, 2)), PARTS) == 2
    opened = versions.read(spark, path)
    draft = versions.prepare_merge(spark, path, rows(spark, (1, "x", 2, 1)), ["id"], PARTS)
    assert found(versions.read(spark, path)) == [(1, "a", 1), (2, "b", 2)]  # written, not published
    versions.publish(spark, draft)
    assert found(opened) == [(1, "a", 1), (2, "b", 2)]
    assert found(versions.read(spark, path)) == [(1, "x", 1), (2, "b", 2)]
    assert found(versions.read(spark, path, number=1)) == [(1, "a", 1), (2, "b", 2)]


def test_the_second_of_two_writers_fails_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark, path, rows(spark, (1, "a", 1, 1)), PARTS)
    one = versions.prepare_merge(spark, path, rows(spark, (2, "b", 1, 2)), ["id"], PARTS)
    two = versions.prepare_merge(spark, path, rows(spark, (3, "c", 1, 3)), ["id"], PARTS)
    versions.publish(spark, one)
    with pytest.raises(versions.ConcurrentWrite):
        versions.publish(spark, two)
    versions.merge(spark, path, rows(spark, (3, "c", 1, 3)), ["id"], PARTS)
    assert found(versions.read(spark, path)) == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]


def test_rows_move_and_emptied_partitions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark, path, rows(spark, (1, "a", 1, 1), (2, "b", 1, 2), (3, "c", 1, 3)), PARTS)
    delta = lake.staged(spark, rows(spark, (1, "A", 2, 2), (4, "d", 2, 4)), "delta").frame
    for _ in range(2):
        versions.merge(spark, path, delta, ["id"], PARTS)
        assert found(versions.read(spark, path)) == [(1, "A", 2), (2, "b", 2), (3, "c", 3), (4, "d", 4)]
    live = {r.month: r.version for r in versions.manifest(spark, path).collect()}
    assert set(live) == {2, 3, 4} and live[3].startswith("v0000000001")  # month 3 was not written again


def test_only_live_and_changed_partitions_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark, path, rows(spark, *[(m, "a", 1, m) for m in range(1, 13)]), PARTS)
    for k in range(3):
        versions.merge(spark, path, lake.staged(spark, rows(spark, (5, f"v{k}", k, 5)), "d").frame, ["id"], PARTS)
    whole = versions.read(spark, path)
    assert "dynamicpruning" in whole._jdf.queryExecution().executedPlan().toString()
    assert scanned_files(whole) == 13  # 12 live; pruning goes by column, so month 5 of a write that is live elsewhere
    changed = versions.changes(spark, path, 1)
    assert found(changed) == [(5, "v2", 5)] and scanned_files(versions.changes(spark, path, 1)) == 1
    assert versions.changes(spark, path, 4).collect() == [] and scanned_files(versions.changes(spark, path, 4)) == 0
    assert scanned_files(versions.read(spark, path).filter("month IN (5, 6)")) == 3


def test_a_stable_merge_searches_the_months_of_the_delta_only(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark, path, rows(spark, (1, "a", 1, 1), (2, "b", 1, 2)), PARTS)
    versions.merge(spark, path, rows(spark, (2, "B", 2, 2), (7, "n", 1, 7)), ["id"], PARTS, stable=True)
    assert found(versions.read(spark, path)) == [(1, "a", 1), (2, "B", 2), (7, "n", 7)]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_the_latest_wins_in_any_order_of_arrival(spark, tmp_path, order):
    path = str(tmp_path / "t")
    deltas = [rows(spark, (1, "first", 1, 1)), rows(spark, (1, "second", 2, 3), (2, "b", 1, 1)), rows(spark, (1, "third", 3, 2))]
    for k in order:
        versions.merge(spark, path, deltas[k], ["id"], PARTS, [F.col("at").desc()], latest_wins=True)
    assert found(versions.read(spark, path)) == [(1, "third", 2), (2, "b", 1)]


def test_tables_without_partitions_or_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], "id int, v string")
    versions.merge(spark, path, empty, ["id"])
    assert versions.read(spark, path, empty.schema).collect() == []
    versions.merge(spark, path, spark.createDataFrame([(1, "a"), (None, "n")], "id int, v string"), ["id"])
    versions.merge(spark, path, spark.createDataFrame([(1, "b"), (None, "m")], "id int, v string"), ["id"])
    assert sorted((r.id or 0, r.v) for r in versions.read(spark, path).collect()) == [(0, "m"), (1, "b")]
    parted = str(tmp_path / "p")
    versions.replace(spark, parted, rows(spark).limit(0), PARTS)
    assert versions.read(spark, parted, rows(spark).schema).collect() == []
    versions.merge(spark, parted, rows(spark, (1, "a", 1, 1)), ["id"], PARTS)
    assert found(versions.read(spark, parted)) == [(1, "a", 1)]


def test_null_partitions_and_other_layouts_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark, path, rows(spark, (1, "a", 1, 1)), PARTS)
    with pytest.raises(Exception, match="month is null"):
        versions.merge(spark, path, spark.createDataFrame([(3, "c", 1, 2024, None)], DDL), ["id"], PARTS)
    with pytest.raises(ValueError, match="not partitioned by year"):
        versions.merge(spark, path, rows(spark, (3, "c", 1, 1)), ["id"], ["year"])
    assert found(versions.read(spark, path)) == [(1, "a", 1)]


def test_vacuum_keeps_what_kept_versions_name(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark, path, rows(spark, (1, "a", 1, 1), (2, "b", 1, 2)), PARTS)
    for k in range(3):
        versions.merge(spark, path, rows(spark, (1, f"v{k}", k, 1)), ["id"], PARTS)
    versions.prepare_merge(spark, path, rows(spark, (9, "lost", 1, 9)), ["id"], PARTS)  # an interrupted write
    assert versions.vacuum(spark, path, keep=2) == 4  # two manifests, version 2's data, the interrupted one's
    assert found(versions.read(spark, path)) == [(1, "v2", 1), (2, "b", 2)]
    assert found(versions.read(spark, path, number=3)) == [(1, "v1", 1), (2, "b", 2)]
    assert versions.vacuum(spark, path, keep=2) == 0
    with pytest.raises(ValueError):
        versions.vacuum(spark, path, keep=0)


def test_a_plain_table_becomes_the_first_version(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, (1, "a", 1, 1), (2, "b", 1, 2)).write.partitionBy(*PARTS).parquet(path)
    lake.merge_table(spark, path, rows(spark, (1, "x", 2, 1)), ["id"], PARTS)
    assert found(lake.read_table(spark, path)) == [(1, "x", 1), (2, "b", 2)]
    assert versions.current(spark, path) == 2


def test_a_merge_makes_the_incoming_rows_once(spark, tmp_path, monkeypatch):
    path, made, stage = str(tmp_path / "t"), [], versions.staged
    versions.replace(spark, path, rows(spark, (1, "a", 1, 1), (2, "b", 1, 1)), PARTS)
    monkeypatch.setattr(versions, "staged", lambda s, df, name: made.append((name, df.columns)) or stage(s, df, name))
    draft = versions.prepare_merge(spark, path, rows(spark, (2, "x", 2, 1), (2, "w", 1, 1), (3, "c", 1, 2)), ["id"], PARTS, [F.desc("at")])
    assert [name for name, _ in made] == ["incoming", "touched"]
    versions.publish(spark, draft)
    assert found(versions.read(spark, path)) == [(1, "a", 1), (2, "x", 1), (3, "c", 2)]


def test_new_keys_are_added_beside_a_month_and_changes_give_it_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.replace(spark, path, rows(spark, (1, "a", 1, 1), (2, "b", 1, 1), (3, "c", 1, 2)), PARTS)
    read, stored = [], versions._rows
    monkeypatch.setattr(versions, "_rows", lambda *args: read.append(args[4:]) or stored(*args))
    versions.merge(spark, path, rows(spark, (4, "d", 1, 1)), ["id"], PARTS)
    assert read == [(True,)]  # the keys are searched, no stored row is read to be written again
    monkeypatch.undo()
    live = sorted((r.month, r.version[:11], r.n_rows) for r in versions.manifest(spark, path).collect())
    assert live == [(1, "v0000000001", 2), (1, "v0000000002", 1), (2, "v0000000001", 1)]
    assert found(versions.read(spark, path)) == [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 1)]
    assert found(versions.changes(spark, path, 1)) == [(1, "a", 1), (2, "b", 1), (4, "d", 1)]
    versions.merge(spark, path, rows(spark, (1, "x", 2, 2), (2, "y", 2, 1)), ["id"], PARTS)  # all of a folder, one row moves
    assert found(versions.read(spark, path)) == [(1, "x", 2), (2, "y", 1), (3, "c", 2), (4, "d", 1)]
    assert found(versions.read(spark, path, number=2)) == [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 1)]


@pytest.mark.parametrize("latest_wins", [False, True])
def test_folders_of_a_month_stay_few(spark, tmp_path, monkeypatch, latest_wins):
    monkeypatch.setattr(versions, "FOLDERS", 2)
    path = str(tmp_path / "t")
    for k in range(5):
        delta = rows(spark, (k, f"v{k}", 1, 1), (None, f"n{k}", k, 1))
        versions.merge(spark, path, delta, ["id"], PARTS, [F.desc("at")], latest_wins=latest_wins)
        assert versions.manifest(spark, path).count() <= 3
    last = sorted((-1 if r.id is None else r.id, r.v) for r in versions.read(spark, path).collect())
    assert last == [(-1, "n4"), *[(k, f"v{k}") for k in range(5)]]
    whole = versions.read(spark, path)
    assert whole.agg(F.sum("at")).first()[0] == 5 + 4 and versions.manifest(spark, path).agg(F.sum("n_rows")).first()[0] == 6
