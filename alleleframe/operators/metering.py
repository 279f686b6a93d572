"""Cost and time reports over a log of query runs.

``run_measured`` runs a query and returns such a run with what its scans read;
``append_runs`` keeps runs as a table.

A run log has columns ``run_id``, ``kind`` (``query`` or ``load``),
``seconds`` and ``bytes_processed``; a usage log has ``start_time``,
``end_time`` and ``charged_seconds``.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from alleleframe.functions.columns import duration_text

# Published rates in USD.
ATHENA_PER_TB = 5.0
BIGQUERY_PER_TB = 6.25
RPU_PER_HOUR = 0.375
REDSHIFT_STORAGE_PER_GB_MONTH = 0.024
BIGQUERY_STORAGE_PER_GB_MONTH = 0.02

_BYTES_PER_TB = 1e12
_BYTES_PER_GB = 1024.0**3


def scan_cost(bytes_processed: Column, rate_per_tb: float) -> Column:
    return bytes_processed / F.lit(_BYTES_PER_TB) * F.lit(rate_per_tb)


def scan_cost_report(runs: DataFrame, rate_per_tb: float) -> DataFrame:
    """Each run with its scanned gigabytes, cost and runtime text."""
    return runs.select(
        "*",
        (F.col("bytes_processed") / F.lit(1e9)).alias("gb_processed"),
        scan_cost(F.col("bytes_processed"), rate_per_tb).alias("cost"),
        duration_text(F.col("seconds")).alias("runtime"),
    )


def scan_cost_totals(runs: DataFrame, rate_per_tb: float) -> DataFrame:
    """Total runtime, bytes and cost of all runs."""
    scanned = F.sum("bytes_processed")
    return runs.agg(
        F.sum("seconds").alias("total_seconds"),
        duration_text(F.sum("seconds")).alias("total_runtime"),
        (scanned / F.lit(1e9)).alias("total_gb"),
        scan_cost(scanned, rate_per_tb).alias("total_cost"),
    )


def runtime_totals(runs: DataFrame) -> DataFrame:
    """Runtime of queries only, cost of queries and loads; no rows give 0."""
    seconds = F.coalesce(F.sum(F.when(F.col("kind") == "query", F.col("seconds"))), F.lit(0.0))
    return runs.agg(
        seconds.alias("total_query_seconds"),
        duration_text(seconds).alias("total_query_runtime"),
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("total_cost"),
    )


def minute_window(start: dt.datetime, end: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """The full minutes around a run, in UTC: usage is charged by the minute."""
    start, end = (
        t.astimezone(dt.timezone.utc).replace(tzinfo=None) if t.tzinfo else t for t in (start, end)
    )
    if end.second or end.microsecond:
        end += dt.timedelta(minutes=1)
    return start.replace(second=0, microsecond=0), end.replace(second=0, microsecond=0)


def charged_cost(
    usage: DataFrame, start: dt.datetime, end: dt.datetime, rate_per_hour: float = RPU_PER_HOUR
) -> DataFrame:
    """Cost of the usage inside the full minutes around a run; none gives 0."""
    first, last = (
        F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in minute_window(start, end)
    )
    hours = F.sum("charged_seconds") / F.lit(3600.0)
    return usage.filter((F.col("start_time") >= first) & (F.col("end_time") <= last)).agg(
        F.coalesce(hours * F.lit(rate_per_hour), F.lit(0.0)).alias("cost_incurred")
    )


def storage_cost(sizes: DataFrame, rate_per_gb_month: float) -> DataFrame:
    """Monthly cost of a one-row relation with ``total_bytes``."""
    gigabytes = F.col("total_bytes") / F.lit(_BYTES_PER_GB)
    return sizes.select(
        "total_bytes",
        gigabytes.alias("total_gb"),
        (gigabytes * F.lit(rate_per_gb_month)).alias("monthly_cost"),
    )


RUN_LOG = (
    "run_id string, name string, kind string, start_time timestamp, seconds double, files bigint, "
    "bytes_processed bigint, rows_read bigint, rows_out bigint"
)
# Names of the scan metrics of executed plans.
_SCAN_METRICS = {"files": "numFiles", "bytes_processed": "filesSize", "rows_read": "numOutputRows"}


def _scans(plan: Any) -> Iterator[Any]:
    """File scans of an executed plan, in adaptive stages and subqueries too; reused ones once."""
    kind = plan.getClass().getSimpleName()
    if kind.startswith("Reused"):
        return
    if kind.startswith("FileSourceScan"):
        yield plan
    inner = []
    if kind.startswith("AdaptiveSparkPlan"):
        inner.append(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        inner.append(plan.plan())
    for group in (plan.children(), plan.subqueries()):
        inner += [group.apply(i) for i in range(group.size())]
    for part in inner:
        yield from _scans(part)


def scan_metrics(df: DataFrame) -> dict[str, int]:
    """Files, bytes and rows that the scans of an executed ``df`` read.

    ``df`` must have been collected itself. PySpark shows these metrics in its
    pages only, so the executed plan is asked; a scan that two branches share
    counts once.
    """
    totals = dict.fromkeys(_SCAN_METRICS, 0)
    for scan in _scans(df._jdf.queryExecution().executedPlan()):
        metrics = scan.metrics()
        for name, metric in _SCAN_METRICS.items():
            if metrics.contains(metric):
                totals[name] += max(0, metrics.apply(metric).value())
    return totals


def run_measured(df: DataFrame, name: str, kind: str = "query") -> tuple[list[Row], dict]:
    """Collect ``df``; its rows, and one row of a run log.

    Rows of the result are counted while they are made, by an observation at its
    top; it does not keep filters or columns from the scans below it.
    """
    seen = Observation(f"run-{uuid.uuid4().hex}")
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    start, clock = dt.datetime.now(dt.timezone.utc), time.monotonic()
    rows = watched.collect()
    run = {
        "run_id": uuid.uuid4().hex,
        "name": name,
        "kind": kind,
        "start_time": start,
        "seconds": time.monotonic() - clock,
        **scan_metrics(watched),
        "rows_out": seen.get["rows"],
    }
    return rows, run


def runs_table(spark: SparkSession, runs: Sequence[dict]) -> DataFrame:
    """Runs of ``run_measured`` as a run log."""
    names = [part.split()[0] for part in RUN_LOG.split(", ")]
    return spark.createDataFrame([tuple(run[n] for n in names) for run in runs], RUN_LOG)


def append_runs(spark: SparkSession, runs: Sequence[dict], path: str) -> DataFrame:
    """Add runs to the run log at ``path``; returns the whole log."""
    runs_table(spark, runs).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(RUN_LOG).parquet(path)
