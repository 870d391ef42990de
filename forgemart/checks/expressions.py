"""Scalar functions on whole columns of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from forgemart.bindings import language_maps, table
from forgemart.checks.base import flat
from forgemart.functions import numbers, texts, times
from forgemart.plans import bronze, star

_DAY = "o_orderdate"


def _orders(columns):
    """``columns`` builds the expressions; they need a running session."""
    return lambda spark, d: table(spark, d, "orders").select("o_orderkey", *columns())


def _calendar(column):
    return lambda spark, d: star.calendar_of(table(spark, d, "orders").select(F.col(_DAY)), _DAY).select(*column)


_MAPS = """
    SELECT l_suppkey, p_type, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bytes
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""

CASES = {
    "F1_date_id": (
        _orders(lambda: [times.date_id(F.col(_DAY)).alias("date_id")]),
        "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id FROM orders",
    ),
    "F2_calendar_parts": (
        _calendar(["date_id", "year", "quarter", "month", "day_of_month"]),
        """SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, CAST(year(o_orderdate) AS INTEGER) AS year,
                  CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(month(o_orderdate) AS INTEGER) AS month,
                  CAST(day(o_orderdate) AS INTEGER) AS day_of_month FROM orders""",
    ),
    "F3_iso_week": (
        _calendar(["date_id", "week"]),
        """SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, CAST(week(o_orderdate) AS INTEGER) AS week
           FROM orders""",
    ),
    "F4_weekday_and_weekend": (
        _calendar(["date_id", "day_of_week", "is_weekend"]),
        """SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id,
                  CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week, isodow(o_orderdate) >= 6 AS is_weekend
           FROM orders""",
    ),
    "F5_month_and_day_names": (
        _calendar(["date_id", "month_name", "day_name"]),
        """SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, monthname(o_orderdate) AS month_name,
                  dayname(o_orderdate) AS day_name FROM orders""",
    ),
    "F5_padded_names": (
        lambda spark, d: star.calendar_of(
            table(spark, d, "orders").select(_DAY), _DAY, padded_names=True).select("date_id", "month_name", "day_name"),
        """SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id,
                  rpad(monthname(o_orderdate), 9, ' ') AS month_name, rpad(dayname(o_orderdate), 9, ' ') AS day_name
           FROM orders""",
    ),
    "F6_hour": (
        lambda spark, d: table(spark, d, "events").select(
            "event_id", F.hour(F.col("ts").cast("timestamp")).alias("hour")),
        "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events",
    ),
    "F7_period_starts": (
        lambda spark, d: table(spark, d, "events").select(
            "event_id", *[times.period_start(p, F.col("ts")).alias(p) for p in times.PERIODS]),
        """SELECT event_id, CAST(date_trunc('day', ts) AS DATE) AS daily, CAST(date_trunc('week', ts) AS DATE) AS weekly,
                  CAST(date_trunc('month', ts) AS DATE) AS monthly FROM events""",
    ),
    "F8_hours_between": (
        lambda spark, d: table(spark, d, "lineitem").join(
            table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
            "l_orderkey", "l_linenumber", times.hours_between(F.col(_DAY), F.col("l_shipdate")).alias("hours")),
        """SELECT l_orderkey, l_linenumber, date_diff('second', o_orderdate, l_shipdate) / 3600.0 AS hours
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "F9_date_series": (
        lambda spark, d: star.calendar_spanning(table(spark, d, "orders"), _DAY).select("full_date"),
        """SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS full_date
           FROM orders""",
    ),
    "F10_conditionals": (
        _orders(lambda: [
            F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("O")), F.lit("none")).alias("status"),
            F.when(F.col("o_totalprice") > 200000, "large").otherwise("small").alias("size"),
        ]),
        """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'O'), 'none') AS status,
                  CASE WHEN o_totalprice > 200000 THEN 'large' ELSE 'small' END AS size FROM orders""",
    ),
    "F11_one_decimal": (
        _orders(lambda: [numbers.one_place(F.col("o_totalprice")).alias("rounded")]),
        """SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(38, 6)), 1) AS DOUBLE) AS rounded FROM orders""",
    ),
    "F12_map_entries": (
        lambda spark, d: language_maps(spark, d).select(
            "repository_full_name", F.explode("languages").alias("language", "bytes")).filter("bytes IS NOT NULL"),
        f"SELECT 'org/repo' || l_suppkey AS repository_full_name, p_type AS language, bytes FROM ({_MAPS})",
    ),
    "F13_map_total": (
        lambda spark, d: language_maps(spark, d).select(
            "repository_full_name", numbers.map_total(F.col("languages")).alias("total_bytes")),
        f"""SELECT 'org/repo' || l_suppkey AS repository_full_name, CAST(sum(bytes) AS BIGINT) AS total_bytes
            FROM ({_MAPS}) GROUP BY l_suppkey""",
    ),
    "F14_names_of_structs": (
        lambda spark, d: flat(table(spark, d, "orders").select("o_orderkey", F.array(
            F.struct(F.col("o_orderpriority").alias("name")),
            F.struct(F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("name"))).alias("labels"))
            .select("o_orderkey", bronze.names_of("labels", "name").alias("names"))),
        """SELECT o_orderkey, o_orderpriority || ',' || coalesce(nullif(o_orderstatus, 'O'), '') AS names FROM orders""",
    ),
    "F15_owner_and_name": (
        lambda spark, d: table(spark, d, "customer").withColumn(
            "full_name", F.concat("c_mktsegment", F.lit("/"), "c_name", F.lit("/x"))).select(
            "c_custkey", texts.owner_of(F.col("full_name")).alias("owner"), texts.repo_of(F.col("full_name")).alias("name")),
        "SELECT c_custkey, c_mktsegment AS owner, c_name || '/x' AS name FROM customer",
    ),
    "F16_file_names": (
        lambda spark, d: table(spark, d, "customer").select(
            "c_custkey", texts.file_stem(F.concat("c_mktsegment", F.lit("/"), "c_name")).alias("stem")),
        "SELECT c_custkey, replace(c_mktsegment || '/' || c_name, '/', '_') AS stem FROM customer",
    ),
    "F17_comma_lists": (
        lambda spark, d: table(spark, d, "part").select("p_partkey", F.explode(texts.comma_list(
            F.concat(F.lit(" , "), F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(",,")))).alias("word")),
        "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part",
    ),
    "F18_number_and_duration_texts": (
        lambda spark, d: table(spark, d, "orders").select(
            "o_orderkey",
            texts.thousands(F.floor("o_totalprice")).alias("price"),
            texts.duration_text(F.col("o_totalprice") / 20).alias("duration")),
        """SELECT o_orderkey, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS price,
                  CASE WHEN s < 60 THEN CAST(round(CAST(s AS DECIMAL(38, 6)), 1) AS DECIMAL(30, 1)) || 's'
                       WHEN s < 3600 THEN CAST(round(CAST(s / 60.0 AS DECIMAL(38, 6)), 1) AS DECIMAL(30, 1)) || 'm'
                       ELSE CAST(round(CAST(s / 3600.0 AS DECIMAL(38, 6)), 1) AS DECIMAL(30, 1)) || 'h' END AS duration
           FROM (SELECT *, o_totalprice / 20 AS s FROM orders)""",
    ),
}
