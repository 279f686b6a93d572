from __future__ import annotations

import datetime as dt

from conftest import rows

from pyspark.sql import functions as F

from alleleframe.operators import metering


def runs(spark):
    return spark.createDataFrame(
        [(1, "query", 60.0, 2 * 10**12, 1.0), (2, "load", 100.0, 10**12, 2.0)],
        "run_id int, kind string, seconds double, bytes_processed bigint, cost double",
    )


def test_scan_cost(spark):
    report = metering.scan_cost_report(runs(spark).drop("cost"), metering.ATHENA_PER_TB)
    assert rows(report, "run_id", "gb_processed", "cost", "runtime") == [
        (1, 2000.0, 10.0, "0.0h1.0m0.00s"),
        (2, 1000.0, 5.0, "0.0h1.0m40.00s"),
    ]
    totals = metering.scan_cost_totals(runs(spark), metering.BIGQUERY_PER_TB)
    assert rows(totals) == [(160.0, "0.0h2.0m40.00s", 3000.0, 18.75)]


def test_published_figures(spark):
    """57.68 GB at 5 and 509.21 GB at 6.25 dollars per terabyte."""
    log = spark.createDataFrame([(57.68e9, 509.21e9)], "a double, b double")
    cost = log.select(metering.scan_cost(log.a, 5.0), metering.scan_cost(log.b, 6.25)).first()
    assert [round(c, 2) for c in cost] == [0.29, 3.18]


def test_load_time_is_excluded_but_not_its_cost(spark):
    assert rows(metering.runtime_totals(runs(spark))) == [(60.0, "0.0h1.0m0.00s", 3.0)]
    empty = runs(spark).limit(0)
    assert rows(metering.runtime_totals(empty)) == [(0.0, "0.0h0.0m0.00s", 0.0)]


def test_minute_window():
    at = dt.datetime
    assert metering.minute_window(at(2024, 1, 1, 9, 5, 30), at(2024, 1, 1, 9, 7, 0, 1)) == (
        at(2024, 1, 1, 9, 5), at(2024, 1, 1, 9, 8),
    )
    assert metering.minute_window(at(2024, 1, 1, 9, 5), at(2024, 1, 1, 9, 7))[1] == at(2024, 1, 1, 9, 7)
    zone = dt.timezone(dt.timedelta(hours=2))
    assert metering.minute_window(at(2024, 1, 1, 9, 5, tzinfo=zone), at(2024, 1, 1, 10, tzinfo=zone)) == (
        at(2024, 1, 1, 7, 5), at(2024, 1, 1, 8, 0),
    )


def test_charged_cost(spark):
    usage = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-01 09:05:00' AS start_time,"
        " TIMESTAMP_NTZ '2024-01-01 09:06:00' AS end_time, 3600 AS charged_seconds"
        " UNION ALL SELECT TIMESTAMP_NTZ '2024-01-01 09:06:00', TIMESTAMP_NTZ '2024-01-01 09:07:01', 3600"
    )
    at = dt.datetime
    inside = metering.charged_cost(usage, at(2024, 1, 1, 9, 5, 59), at(2024, 1, 1, 9, 6, 30))
    assert rows(inside) == [(0.375,)]
    nothing = metering.charged_cost(usage, at(2025, 1, 1), at(2025, 1, 2))
    assert rows(nothing) == [(0.0,)]


def test_storage_cost(spark):
    sizes = spark.createDataFrame([(2 * 1024**3,)], "total_bytes bigint")
    cost = metering.storage_cost(sizes, metering.BIGQUERY_STORAGE_PER_GB_MONTH)
    assert rows(cost) == [(2 * 1024**3, 2.0, 0.04)]


def test_runs_are_measured_and_kept(spark, tmp_path):
    """What the scans read, the rows that came out, and both reports on the log."""
    path = str(tmp_path / "t")
    spark.range(5000).selectExpr("id", "id % 10 AS k", "repeat('x', 50) AS pad").coalesce(2).write.parquet(path)
    df = spark.read.parquet(path)
    rows_, run = metering.run_measured(df.groupBy("k").count(), "by_k")
    assert len(rows_) == 10
    assert (run["files"], run["rows_read"], run["rows_out"]) == (2, 5000, 10)
    assert run["bytes_processed"] > 0
    twice = df.select("id").join(df.select(F.col("id").alias("other")), F.col("id") == F.col("other"))
    _, both = metering.run_measured(twice, "join")
    assert both["rows_read"] in (5000, 10_000)
    _, none = metering.run_measured(spark.range(3), "range")
    assert (none["files"], none["rows_read"], none["rows_out"]) == (0, 0, 3)
    log = str(tmp_path / "log")
    assert metering.append_runs(spark, [run, both], log).count() == 2
    kept = metering.append_runs(spark, [none], log)
    assert kept.count() == 3
    totals = metering.scan_cost_totals(kept, metering.ATHENA_PER_TB).first()
    assert totals.total_gb == (run["bytes_processed"] + both["bytes_processed"]) / 1e9
    report = metering.scan_cost_report(kept, metering.ATHENA_PER_TB)
    assert metering.runtime_totals(report).first().total_query_seconds > 0


def test_a_measured_run_keeps_its_pushed_filters(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id AS other").write.parquet(path)
    _, run = metering.run_measured(spark.read.parquet(path).where("id > 10").select("id"), "filtered")
    assert run["rows_out"] == 89
