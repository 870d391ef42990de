"""The exact median against numpy, on even, odd, tied, negative and skewed groups."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forgemart.operators.median import grouped_median


def medians(spark, rows, keys=("g",)):
    df = spark.createDataFrame(rows, "g string, hours double")
    return {tuple(r[k] for k in keys): r.m for r in grouped_median(df, list(keys), "hours", "m").collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-10**9, 10**9)), min_size=1, max_size=60))
def test_any_values(spark, rows):
    rows = [(g, s / 3600.0) for g, s in rows]
    found = medians(spark, rows)
    for g in {g for g, _ in rows}:
        assert found[(g,)] == pytest.approx(float(np.median([h for k, h in rows if k == g])), rel=1e-12)


def test_nulls_are_ignored_and_empty_groups_left_out(spark):
    assert medians(spark, [("a", 1.0), ("a", None), ("a", 2.0), ("b", None)]) == {("a",): 1.5}


def test_no_rows_at_all(spark):
    assert medians(spark, [("a", None)], keys=()) == {}


def test_one_value_dominates(spark):
    rows = [("a", 5.0)] * 400 + [("a", float(i)) for i in range(300)] + [("a", 1e6)] * 100
    assert medians(spark, rows)[("a",)] == float(np.median([h for _, h in rows]))


def test_middle_ranks_in_different_buckets(spark):
    assert medians(spark, [("a", 0.0), ("a", 1000.0)])[("a",)] == 500.0


def test_the_input_is_scanned_once(spark, tmp_path):
    spark.range(5000).select((F.col("id") % 7).alias("g"), (F.col("id") * 1.5).alias("hours")).write.parquet(str(tmp_path / "t"))
    out = grouped_median(spark.read.schema("g long, hours double").parquet(str(tmp_path / "t")), ["g"], "hours", "m")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]


def test_summary_of_groups_with_null_keys_and_values(spark):
    import statistics

    from forgemart.operators.median import grouped_summary

    rnd = random.Random(9)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, rnd.uniform(-50, 900)]), rnd.random() < 0.3) for _ in range(400)]
    rows += [(7, None, True)]
    df = spark.createDataFrame(rows, "k int, h double, x boolean")
    counts = {"n": F.lit(True), "n_x": F.col("x")}

    def expected(part):
        known = [h for _, h, _ in part if h is not None]
        middle = (statistics.fmean(known), statistics.median(known)) if known else (None, None)
        return len(part), sum(x for *_, x in part), *middle

    for r in grouped_summary(df, ["k"], "h", counts, "mean", "median").collect():
        n, n_x, mean, median = expected([row for row in rows if row[0] == r.k])
        assert (r.n, r.n_x) == (n, n_x)
        assert (r["mean"], r["median"]) == (pytest.approx(mean), pytest.approx(median)) if mean is not None else r["median"] is None
    whole = grouped_summary(df, [], "h", counts, "mean", "median").first()
    assert (whole.n, whole.n_x) == expected(rows)[:2] and whole["median"] == pytest.approx(expected(rows)[3])
    empty = grouped_summary(df.limit(0), [], "h", counts, "mean", "median").first()
    assert tuple(empty) == (0, 0, None, None)
