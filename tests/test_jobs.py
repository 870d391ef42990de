"""The batch jobs from landed files to the stored star."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from forgemart import jobs, schemas
from forgemart.jobs import bronze_to_silver, ingest, silver_to_gold
from forgemart.plans import commits, repositories, star
from forgemart.session import RUNTIME_CONF, configure, scratch_path
from forgemart.sources import gold, lake
from test_lake import land


def repository(i, name, **more):
    return {"id": i, "full_name": name, "owner": "a", "name": name[2:], "updated_at": "2024-01-01T00:00:00Z", **more}


def commit(sha, login, when="2024-01-05T10:00:00Z", repo="a/b", **more):
    return {"sha": sha, "repository_full_name": repo, "author_login": login, "author_date": when, "additions": 5, **more}


@pytest.fixture
def paths(tmp_path):
    land(tmp_path, "repositories", 1, "a_b", repository(1, "a/b"))
    land(tmp_path, "repositories", 1, "bad", "{nope")
    land(tmp_path, "commits", 1, "a_b", [commit("s1", "ann"), commit("s2", None), commit("s3", "ann", when="")])
    land(tmp_path, "commits", 1, "no_ne", [commit("s9", "ann", repo="no/ne")])
    land(tmp_path, "contributors", 1, "a_b", [{"id": 7, "login": "ann", "repository_full_name": "a/b"}])
    land(tmp_path, "languages", 1, "a_b", {"repository_full_name": "a/b", "languages": {"Go": 3, "C": 1}, "total_bytes": 4})
    return lake.LakePaths(str(tmp_path))


def test_files_to_star_and_a_second_day(spark, paths, tmp_path):
    assert bronze_to_silver(spark, paths, multi_line=True) == {"repositories": 1, "commits": 3, "contributors": 1, "languages": 1}
    rejected = spark.read.schema("_corrupt_record string").json(paths.silver("rejected_repositories"))
    assert "nope" in spark.read.text(paths.silver("rejected_repositories")).first().value and rejected is not None
    first = silver_to_gold(spark, paths, "1")
    for name, table in first.tables().items():
        assert {f.name: f.dataType for f in table.schema} == {f.name: f.dataType for f in schemas.gold(name)}, name
    row = repositories.repository_overview(first).first()
    assert (row.full_name, row.total_commits, row.total_prs, row.total_additions) == ("a/b", 2, 0, 10)
    assert [r.sha for r in spark.read.parquet(paths.gold("rejected_fact_commits") + "/load=1").collect()] == ["s9"]
    keys = {r.login: r.user_id for r in first.user.collect()}
    assert first.user.filter("etl_loaded_at IS NULL").isEmpty()

    land(tmp_path, "repositories", 2, "a_c", [repository(2, "a/c"), repository(1, "a/b", stars_count=9)])
    land(tmp_path, "commits", 2, "a_b", [commit("s1", "ann", message="again"), commit("s4", "bob", when="2024-02-01T00:00:00Z")])
    bronze_to_silver(spark, paths, multi_line=True, incremental=True)
    second = silver_to_gold(spark, paths, "2", previous_id="1")
    assert {r.login: r.user_id for r in second.user.collect()}["ann"] == keys["ann"] and second.user.count() == 2
    found = repositories.list_repositories(second, sort_by="total_commits").collect()
    assert [(r.full_name, r.total_commits, r.stars_count) for r in found] == [("a/b", 3, 9), ("a/c", 0, 0)]
    assert second.commits.filter("sha = 's1'").first().message == "again"
    assert [r.login for r in commits.top_contributors(second, limit=5).collect()] == ["ann", "bob"]


def test_calendar_reaches_all_facts_and_unknown_languages_are_kept(spark, paths, tmp_path):
    land(tmp_path, "commits", 1, "old", [commit("s5", "ann", when="2018-03-04T10:00:00Z"), commit("s6", "ann", when="2031-02-01T00:00:00Z")])
    land(tmp_path, "languages", 1, "no_ne", {"repository_full_name": "no/ne", "languages": {"C": 1}, "total_bytes": 1})
    bronze_to_silver(spark, paths, multi_line=True)
    built = silver_to_gold(spark, paths, "1")
    ends = built.date.agg({"date_id": "min"}).first()[0], built.date.agg({"date_id": "max"}).first()[0]
    assert ends == (20180304, 20310201)
    assert sum(r.commit_count for r in commits.daily_commit_activity(built).collect()) == built.commits.count()
    assert [r.repository_full_name for r in spark.read.parquet(paths.gold("rejected_repo_languages") + "/load=1").collect()] == ["no/ne"]
    assert silver_to_gold(spark, paths, "2").date.count() == built.date.count()


def test_recent_landings_are_merged_and_keys_stay(spark, paths, tmp_path):
    bronze_to_silver(spark, paths, multi_line=True)
    first = silver_to_gold(spark, paths, "1")
    keys = {r.full_name: r.repository_id for r in first.repo.collect()}
    land(tmp_path, "repositories", 2, "more", [repository(k, f"a/r{k}") for k in range(10, 60)])
    land(tmp_path, "commits", 2, "a_b", [commit("s4", "ann", when="2024-02-01T00:00:00Z")])
    land(tmp_path, "contributors", 2, "a_b", [{"id": 8, "login": "bob", "repository_full_name": "a/b"}])
    bronze_to_silver(spark, paths, since=date(2024, 1, 2), multi_line=True)
    silver = {e: lake.read_silver(spark, paths, e) for e in ("commits", "contributors", "repositories")}
    assert {e: t.count() for e, t in silver.items()} == {"commits": 4, "contributors": 2, "repositories": 51}
    second = silver_to_gold(spark, paths, "2")  # goes on from load 1 by itself
    assert {r.full_name: r.repository_id for r in second.repo.collect()}["a/b"] == keys["a/b"]
    found = second.commits.groupBy("sha").count().collect()
    assert sorted((r.sha, r["count"]) for r in found) == [("s1", 1), ("s2", 1), ("s4", 1)]
    again = silver_to_gold(spark, paths, "2")
    assert sorted(r.sha for r in again.commits.collect()) == ["s1", "s2", "s4"]


def test_a_bare_login_keeps_the_known_user(spark, paths):
    bronze_to_silver(spark, paths, multi_line=True)
    silver_to_gold(spark, paths, "1")
    lake.read_silver(spark, paths, "contributors").filter("login = 'none'").write.mode("overwrite").parquet(paths.silver("x"))
    spark.read.parquet(paths.silver("x")).write.mode("overwrite").parquet(paths.silver("contributors"))
    second = silver_to_gold(spark, paths, "2")
    assert [(r.login, r.github_user_id) for r in second.user.collect()] == [("ann", 7)]


def test_document_files_load_or_fail(spark, tmp_path):
    folder = tmp_path / "lake"
    target = folder / "bronze/commits/year=2024/month=01/day=01"
    paths = lake.LakePaths(str(folder))
    land(folder, "commits", 1, "a_b", [commit("s1", "ann")])
    bronze_to_silver(spark, paths, multi_line=True)
    assert target.exists()
    for file in target.iterdir():
        file.write_text('[\n  {\n    "sha": "s2",\n    "repository_full_name": "a/b"\n  }\n]')
    with pytest.raises(ValueError, match="multi_line"):
        bronze_to_silver(spark, paths)
    assert [r.sha for r in lake.read_silver(spark, paths, "commits").collect()] == ["s1"]


def test_nothing_landed(spark, tmp_path):
    paths = lake.LakePaths(str(tmp_path / "none"))
    assert bronze_to_silver(spark, paths) == {}
    built = silver_to_gold(spark, paths, "1")
    assert [t.count() for n, t in built.tables().items() if n != "dim_date"] == [0] * 6


def test_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    configure(spark)
    assert all(spark.conf.get(key) == value for key, value in RUNTIME_CONF.items())


def test_scratch_needs_a_shared_folder_outside_local_mode(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Elsewhere:
        conf = Conf()

        class sparkContext:
            master = "yarn"
            applicationId = "x"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Elsewhere(), "t")


def test_defaults_fill_only_what_is_left_out(spark):
    given = spark.createDataFrame([(1, "a/b", None)], "repository_id long, full_name string, size_kb int")
    row = star.with_defaults("dim_repository", given).first()
    assert (row.default_branch, row.is_fork, row.stars_count, row.size_kb, row.owner) == ("main", False, 0, None, None)


def test_early_and_late_dates_survive_storage(spark, tmp_path):
    early = spark.createDataFrame([(date(1000, 1, 1),), (date(9999, 12, 31),)], "d date")
    early.write.parquet(str(tmp_path / "t"))
    assert sorted(r.d for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [date(1000, 1, 1), date(9999, 12, 31)]


def run_log(spark, paths):
    rows = spark.read.schema(schemas.RUN_LOG_DDL).parquet(paths.run_log()).orderBy("started_at").collect()
    return [(r.status, r.total_commits, r.errors) for r in rows]


def test_facts_wait_for_their_repository(spark, tmp_path):
    paths = lake.LakePaths(str(tmp_path))
    land(tmp_path, "repositories", 1, "a_b", repository(1, "a/b"))
    land(tmp_path, "commits", 1, "a_b", [commit("s1", "ann"), commit("s2", "ann", repo="a/late", when="2024-03-01T00:00:00Z")])
    bronze_to_silver(spark, paths, multi_line=True)
    first = silver_to_gold(spark, paths, "1")
    assert [r.sha for r in first.commits.collect()] == ["s1"]
    land(tmp_path, "commits", 2, "a_b", [commit("s3", "ann", when="2024-02-01T00:00:00Z")])
    bronze_to_silver(spark, paths, since=date(2024, 1, 2), multi_line=True)
    second = silver_to_gold(spark, paths, "2", incremental=True)
    assert sorted(r.sha for r in second.commits.collect()) == ["s1", "s3"]
    land(tmp_path, "repositories", 3, "a_late", repository(2, "a/late"))
    bronze_to_silver(spark, paths, since=date(2024, 1, 3), multi_line=True)
    for load in ("3", "3"):  # a repeated load gives the same
        third = silver_to_gold(spark, paths, load, incremental=True)
        assert sorted(r.sha for r in third.commits.collect()) == ["s1", "s2", "s3"]
        assert spark.read.parquet(paths.gold("quarantine_commits") + f"/load={load}").isEmpty()
    found = {r.full_name: r.total_commits for r in repositories.repository_overview(third).collect()}
    assert found == {"a/b": 2, "a/late": 1}
    fourth = silver_to_gold(spark, paths, "4", incremental=True)  # nothing has changed
    assert fourth.commits.count() == 3
    done = gold.finished_load(spark, paths, "4")
    assert done["loaded"]["fact_commits"] == 0 and done["silver_versions"]["commits"] == 2


def test_an_incremental_load_reads_changed_months_only(spark, tmp_path, monkeypatch):
    paths = lake.LakePaths(str(tmp_path))
    land(tmp_path, "repositories", 1, "a_b", repository(1, "a/b"))
    land(tmp_path, "commits", 1, "a_b", [commit(f"s{m}", "ann", when=f"2023-{m:02}-05T00:00:00Z") for m in range(1, 13)])
    bronze_to_silver(spark, paths, multi_line=True)
    silver_to_gold(spark, paths, "1")
    land(tmp_path, "commits", 2, "a_b", [commit("s99", "ann", when="2023-07-09T00:00:00Z")])
    bronze_to_silver(spark, paths, since=date(2024, 1, 2), multi_line=True)
    seen = {}
    load_star = gold.load_star
    monkeypatch.setattr(gold, "load_star", lambda s, tables, *a, **k: seen.update(tables) or load_star(s, tables, *a, **k))
    built = silver_to_gold(spark, paths, "2", incremental=True)
    assert built.commits.count() == 13
    assert sorted(r.sha for r in seen["commits"].collect()) == ["s7", "s99"]
    assert "dynamicpruning" in seen["commits"]._jdf.queryExecution().executedPlan().toString()


def test_rows_that_break_constraints_are_set_aside_with_reasons(spark, tmp_path):
    paths = lake.LakePaths(str(tmp_path))
    land(tmp_path, "repositories", 1, "a_b", [repository(1, "a/b"), repository(None, "a/x"), repository(3, "a/" + "y" * 300)])
    land(tmp_path, "commits", 1, "a_b", [commit("s1", "ann"), commit("l" * 41, "ann"), commit(None, "bob", repo="no/ne")])
    users = [{"id": 7, "login": "ann"}, {"id": 7, "login": "ann2"}, {"id": 8, "login": None}, {"id": None, "login": "carl"}]
    land(tmp_path, "contributors", 1, "a_b", [{"repository_full_name": f"a/{k}", **u} for k, u in enumerate(users)])
    bronze_to_silver(spark, paths, multi_line=True)
    built = silver_to_gold(spark, paths, "1")

    def reasons(name):
        rows = spark.read.parquet(f"{paths.gold(f'rejected_{name}')}/load=1").collect()
        return sorted(r.reasons for r in rows)

    assert [r.sha for r in built.commits.collect()] == ["s1"]
    assert reasons("fact_commits") == [["sha has over 40 characters"], ["sha is null", "repository_id is null"]]
    assert reasons("dim_repository") == [["full_name has over 255 characters", "name has over 200 characters"], ["github_repo_id is null"]]
    assert reasons("dim_user") == [["github_user_id occurs twice"], ["login is null"]]
    assert built.user.count() == 3
    assert run_log(spark, paths)[-1] == (
        "completed_with_errors", 1, ["dim_repository: 2 rows rejected", "dim_user: 2 rows rejected", "fact_commits: 2 rows rejected"])


def test_every_run_is_logged(spark, tmp_path):
    paths = lake.LakePaths(str(tmp_path))
    payloads = {
        "commits": spark.createDataFrame([('{"sha": "s1", "repository_full_name": "a/b"}',), ("{nope",)], "payload string"),
        "issues": spark.createDataFrame([("{}",)], "payload string").withColumn("payload", F.raise_error(F.lit("lost")).cast("string")),
        "contributors": spark.createDataFrame([], "payload string"),
    }
    assert ingest(spark, paths, payloads, date(2024, 1, 1)) == {"commits": 1, "issues": 0, "contributors": 0}
    assert bronze_to_silver(spark, paths)["commits"] == 0  # undated
    land(tmp_path, "repositories", 1, "bad", "{nope")
    with pytest.raises(ValueError):
        bronze_to_silver(spark, paths)
    log = run_log(spark, paths)
    assert [(s, n) for s, n, _ in log] == [("completed_with_errors", 1), ("completed", 0), ("failed", 0)]
    assert log[0][2][0] == "commits: 1 unreadable payloads" and log[0][2][1].startswith("issues: ")
    assert log[2][2][1].startswith("repositories: 1 unreadable") or "no readable record" in " ".join(log[2][2])


def test_ingested_commits_start_at_a_moment(spark, tmp_path):
    paths = lake.LakePaths(str(tmp_path))
    texts = [json.dumps({"sha": f"s{d}", "commit": {"author": {"date": f"2024-01-0{d}T00:00:00Z"}}}) for d in (1, 2, 3)]
    payloads = {"commits": spark.createDataFrame([(t,) for t in texts], "payload string")}
    assert ingest(spark, paths, payloads, date(2024, 2, 1), commits_since=F.lit("2024-01-02T00:00:00Z")) == {"commits": 2}


def test_only_unreadable_payloads_are_parsed_twice(spark, tmp_path, monkeypatch):
    lakes, kept = lake.LakePaths(str(tmp_path / "lake")), {}
    apart = jobs._kept_apart

    def seen(bad, path, run, name):
        kept[name] = "from_json" in bad._jdf.queryExecution().optimizedPlan().toString()
        return apart(bad, path, run, name)

    monkeypatch.setattr(jobs, "_kept_apart", seen)
    texts = {
        "contributors": ['{"id": 1, "login": "ann", "repository_full_name": "a/b"}', "{nope"],
        "languages": ['{"repository_full_name": "a/b", "languages": {"Go": 1}}'],
    }
    payloads = {e: spark.createDataFrame([(t,) for t in lines], "payload string") for e, lines in texts.items()}
    assert ingest(spark, lakes, payloads, date(2024, 1, 1), "r") == {"contributors": 1, "languages": 1}
    assert kept == {"contributors": True, "languages": False}
    assert [r.value for r in spark.read.text(lakes.bronze("rejected_contributors")).select("value").collect()] == ['{"_corrupt_record":"{nope"}']
    assert spark.read.schema("value string").json(f"{lakes.bronze('rejected_languages')}/run=r").count() == 0
    log = spark.read.parquet(lakes.run_log()).first()
    assert (log.status, log.errors) == ("completed_with_errors", ["contributors: 1 unreadable payloads"])


@pytest.mark.parametrize("incremental", [False, True])
def test_landed_records_are_parsed_once_unless_some_are_unreadable(spark, tmp_path, monkeypatch, incremental):
    lakes, kept = lake.LakePaths(str(tmp_path)), {}
    apart = jobs._kept_apart

    def seen(bad, path, run, name):
        kept[name] = "json" in bad._jdf.queryExecution().executedPlan().toString().lower()
        return apart(bad, path, run, name)

    monkeypatch.setattr(jobs, "_kept_apart", seen)
    lines = {
        "repositories": [repository(1, "a/b"), repository(2, "a/odd", topics={"no": "list"})],  # silver doesn't read topics
        "commits": [commit("s1", "ann", when="")],  # undated
        "contributors": [{"id": 7, "login": "ann", "repository_full_name": "a/b"}],
        "languages": [{"repository_full_name": "a/b", "languages": {"Go": 3}, "total_bytes": 3}],
    }
    for entity, records in lines.items():
        broken = ["{nope"] if entity in ("commits", "contributors") else []
        land(tmp_path, entity, 1, "a", "\n".join([*map(json.dumps, records), *broken]))
    counts = bronze_to_silver(spark, lakes, incremental=incremental, run_id="r")
    assert counts == {"repositories": 2, "commits": 0, "contributors": 1, "languages": 1}
    assert kept == {"repositories": True, "commits": True, "contributors": True, "languages": False}
    assert sorted(r.full_name for r in lake.read_silver(spark, lakes, "repositories").collect()) == ["a/b", "a/odd"]
    log = spark.read.parquet(lakes.run_log()).first()
    assert log.errors == [f"{e}: 1 unreadable records" for e in ("commits", "contributors", "repositories")]
    data = tmp_path / "silver/repositories/data"
    assert len([f for f in data.iterdir() if f.name.startswith("version=")]) == 1  # nothing of a first try stays
