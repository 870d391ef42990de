"""Streams: late rows, copies across batches, repeated batches."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from forgemart.plans import silver
from forgemart.sources import versions
from forgemart.sources.lake import LakePaths
from forgemart.streaming import feeds


def drop(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def commit(sha, when, **more):
    return {"sha": sha, "repository_full_name": "a/b", "author_date": when, **more}


def test_copies_in_later_files_are_dropped(spark, tmp_path):
    day = tmp_path / "bronze/commits/year=2024/month=01/day=01"
    drop(day, "1.json", [commit("a", "2024-01-01T00:00:00Z"), commit("a", "2024-01-01T00:00:00Z"), commit("x", "")])
    drop(day, "2.json", [commit("a", "2024-01-01T00:00:00Z"), commit("b", "2024-01-02T00:00:00Z", additions=3)])
    stream = feeds.read_bronze_stream(spark, LakePaths(str(tmp_path)), "commits", files_per_trigger=1)
    cleaned = feeds.stream_clean(stream, "commits", "10 days")
    feeds.append_to(cleaned, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("sha").collect()
    assert [(r.sha, r.additions, r.author_name, r.month) for r in rows] == [("a", 0, "Unknown", 1), ("b", 3, "Unknown", 1)]
    # A restart from the same checkpoint finds nothing new.
    feeds.append_to(cleaned, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    base = datetime(2024, 1, 1)

    def events(*hours):
        return [{"ts": (base + timedelta(hours=h)).isoformat()} for h in hours]

    source = tmp_path / "in"
    drop(source, "1.json", events(0, 1, 30))
    drop(source, "2.json", events(60))
    drop(source, "3.json", events(2, 100))  # hour 2 comes after its day was closed and given out
    for i in (1, 2, 3):
        os.utime(source / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).json(str(source))
    counts = feeds.windowed_counts(stream, "ts", "1 hour", size="1 day")
    feeds.append_to(counts, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r.window_start.day, r.n_rows) for r in rows] == [(1, 2), (2, 1), (3, 1)]


@pytest.mark.parametrize("bad", [{}, {"size": "1 day", "gap": "1 hour"}, {"gap": "1 hour"}])
def test_window_arguments(spark, bad):
    with pytest.raises(ValueError):
        feeds.windowed_counts(spark.readStream.format("rate").load(), "timestamp", "1 hour", **bad)


def test_stale_rows_of_a_lost_checkpoint_never_win(spark, tmp_path):
    source, facts = tmp_path / "in", str(tmp_path / "facts")
    drop(source, "1.json", [{"id": 1, "v": 1, "at": 1}, {"id": 2, "v": 1, "at": 1}])
    stream = spark.readStream.schema("id int, v int, at int").json(str(source))

    def to_fact(batch):
        return batch.withColumn("w", F.col("v") * 10)

    def load(check, feed="main"):
        feeds.stream_load(stream, to_fact, facts, str(tmp_path / check), feed).awaitTermination()

    def current():
        return [tuple(r) for r in feeds.loaded_facts(spark, facts, ["id"], "at").select("id", "v", "w").orderBy("id").collect()]

    load("check")
    load("other")  # a lost checkpoint replays the first batch
    assert current() == [(1, 1, 10), (2, 1, 10)]
    drop(source, "2.json", [{"id": 2, "v": 7, "at": 2}, {"id": 3, "v": 1, "at": 1}])
    load("check")
    assert current() == [(1, 1, 10), (2, 7, 70), (3, 1, 10)]
    assert feeds.compact_log(spark, facts, ["id"], "at") == 6
    assert feeds.compact_log(spark, facts, ["id"], "at") == 0
    assert current() == [(1, 1, 10), (2, 7, 70), (3, 1, 10)]
    (source / "2.json").unlink()
    load("third")  # the early states again, after the late ones were folded
    assert current() == [(1, 1, 10), (2, 7, 70), (3, 1, 10)]
    drop(source, "3.json", [{"id": 1, "v": 9, "at": 5}])
    load("feed-b", "b")  # another feed starts with batch 0 as well
    assert current() == [(1, 9, 90), (2, 7, 70), (3, 1, 10)]
    feeds.compact_log(spark, facts, ["id"], "at")
    assert current() == [(1, 9, 90), (2, 7, 70), (3, 1, 10)]


def test_a_repeated_batch_is_logged_once(spark, tmp_path):
    source, facts, check = tmp_path / "in", str(tmp_path / "facts"), tmp_path / "check"
    drop(source, "1.json", [{"id": 1, "v": 1}])
    stream = spark.readStream.schema("id int, v int").json(str(source))
    feeds.stream_load(stream, lambda batch: batch, facts, str(check)).awaitTermination()
    for name in ("0", ".0.crc"):
        (check / "commits" / name).unlink(missing_ok=True)  # the batch ran, its commit was lost
    feeds.stream_load(stream, lambda batch: batch, facts, str(check)).awaitTermination()
    assert spark.read.parquet(f"{facts}/log").count() == 1
    rows = feeds.loaded_facts(spark, facts, ["id"])
    assert [(r.id, r.v) for r in rows.collect()] == [(1, 1)] and rows.columns == ["id", "v"]


def pull(i, state, updated, created="2019-05-01T00:00:00Z", **more):
    return {"id": i, "repository_full_name": "a/b", "state": state, "created_at": created, "updated_at": updated, **more}


def test_the_latest_record_stays_whatever_arrives_last(spark, tmp_path):
    paths, table, check = LakePaths(str(tmp_path)), str(tmp_path / "table"), str(tmp_path / "check")
    folder = tmp_path / "bronze/pull_requests/year=2024/month=01"

    def run():
        stream = feeds.read_bronze_stream(spark, paths, "pull_requests", files_per_trigger=1)
        feeds.merge_records(feeds.stream_versions(stream, "pull_requests", "1 second"), "pull_requests", table, check).awaitTermination()
        rows = feeds.merged_records(spark, table, "pull_requests").orderBy("github_pr_id").collect()
        return [(r.github_pr_id, r.state, r.draft, r.time_to_merge_hours) for r in rows]

    assert feeds.merged_records(spark, table, "pull_requests") is None
    drop(folder / "day=05", "1.json", [pull(1, "open", "2024-01-05T00:00:00Z"), pull(2, "closed", "2024-01-05T00:00:00Z")])
    assert run() == [(1, "open", False, None), (2, "closed", False, None)]
    merged = "2019-05-01T02:00:00Z"
    drop(folder / "day=06", "2.json", [pull(1, "closed", "2024-01-06T00:00:00Z", merged_at=merged)])
    drop(folder / "day=04", "3.json", [pull(2, "open", "2024-01-09T00:00:00Z"), pull(3, "open", "2024-01-01T00:00:00Z", created="1999-01-01T00:00:00Z")])
    expected = [(1, "closed", False, 2.0), (2, "closed", False, None), (3, "open", False, None)]
    assert run() == expected  # an earlier landing day never wins, an old creation date is not late
    drop(folder / "day=06", "4.json", [pull(1, "closed", "2024-01-06T00:00:00Z", merged_at=merged), pull(9, "open", "", created="")])
    assert run() == expected
    batch = spark.read.schema(feeds.read_bronze_stream(spark, paths, "pull_requests").schema).json(paths.bronze("pull_requests"))
    by_batch = silver.clean("pull_requests", batch)
    streamed = feeds.merged_records(spark, table, "pull_requests").select(by_batch.columns)
    assert streamed.exceptAll(by_batch).isEmpty() and by_batch.exceptAll(streamed).isEmpty()


def test_open_windows_are_stored_and_sessions_closed(spark, tmp_path):
    source, closings = tmp_path / "in", str(tmp_path / "closings")
    drop(source, "1.json", [{"ts": "2024-01-01T01:00:00", "u": "x"}, {"ts": "2024-01-01T02:00:00", "u": "x"}])
    events = spark.readStream.schema("ts timestamp, u string").json(str(source))
    daily = feeds.windowed_counts(events, "ts", "1 hour", size="1 day")

    def stored():
        feeds.merge_windows(daily, str(tmp_path / "days"), ["window_start"], str(tmp_path / "check")).awaitTermination()
        return [(r.window_start.day, r.n_rows) for r in versions.read(spark, str(tmp_path / "days")).orderBy("window_start").collect()]

    assert stored() == [(1, 2)]
    drop(source, "2.json", [{"ts": "2024-01-01T03:00:00", "u": "x"}, {"ts": "2024-01-02T00:00:00", "u": "y"}])
    assert stored() == [(1, 3), (2, 1)]
    feeds.close_feed(spark, "ts", closings)
    both, closing = feeds.with_closing(events, "ts", closings)
    sessions = feeds.windowed_counts(both, "ts", "1 hour", gap="90 minutes", by=["u"], closing=closing)
    feeds.append_to(sessions, str(tmp_path / "out"), str(tmp_path / "ends")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("u").collect()
    assert [(r.u, r.n_rows) for r in rows] == [("x", 3), ("y", 1)]


def test_a_streamed_merge_writes_few_files(spark, tmp_path):
    table, days = str(tmp_path / "table"), tmp_path / "bronze/pull_requests/year=2024/month=01/day=01"
    months = [f"2019-{m:02d}-01T00:00:00Z" for m in (5, 6)]
    drop(days, "1.json", [pull(i, "open", "2024-01-01T00:00:00Z", months[i % 2]) for i in range(200)])
    stream = feeds.read_bronze_stream(spark, LakePaths(str(tmp_path)), "pull_requests")
    feeds.merge_records(feeds.stream_versions(stream, "pull_requests", "1 second"), "pull_requests", table, str(tmp_path / "check")).awaitTermination()
    assert feeds.merged_records(spark, table, "pull_requests").count() == 200
    assert len(list((tmp_path / "table/data").rglob("*.parquet"))) == 2  # one a month, not one a task and month
