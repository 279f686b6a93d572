"""Time the report suite on the tables in $BENCH_SF_DIR; prints one JSON line.

The merged table is built and published first (timed as ``build_sec``), as the
reports are meant to be run. ``queries`` are the 19 reports on that table: the
median of ``$BENCH_REPEATS`` passes over all of them (default 3), in order, after
a first pass that is given apart.
``from_base`` are the same reports with the three-table join inside.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alleleframe.operators.reshape import MERGE_KEYS
from alleleframe.plans import reports
from alleleframe.session import scratch_path, session_builder
from alleleframe.sinks.storage import stored_size, write_clustered
from checks import derived, registered


def timed(make) -> float:
    started = time.perf_counter()
    make().collect()
    return round(time.perf_counter() - started, 3)


def two_scan_share(variants: DataFrame) -> DataFrame:
    """Share of total with a count action first, for comparison only."""
    total = variants.count()
    counts = variants.groupBy("info_af_range").count()
    return counts.withColumn("pct", F.round(F.col("count") / total * 100, 3)).orderBy(
        "info_af_range"
    )


def scale_factor(sf_dir: str) -> float | str:
    name = Path(sf_dir).name.removeprefix("sf")
    return float(name) if name.replace(".", "", 1).isdigit() else name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = (
        session_builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    started = time.perf_counter()
    path = scratch_path(spark, "merged")
    # Small files, so that tables of this size still give every core a file.
    variants = write_clustered(
        derived.merged_variants(spark, sf_dir), path, MERGE_KEYS, target_mb=4
    )
    genes = write_clustered(
        derived.genes(spark, sf_dir), scratch_path(spark, "genes"), ["Gene_name"]
    )
    build = time.perf_counter() - started

    suite = {n: (lambda f=f: f(variants, genes)) for n, f in reports.REPORTS.items()}
    cold = {name: timed(make) for name, make in suite.items()}
    passes = [
        {name: timed(make) for name, make in suite.items()}
        for _ in range(int(os.environ.get("BENCH_REPEATS", 3)))
    ]
    warm = {name: statistics.median(times[name] for times in passes) for name in suite}
    base = {
        name: timed(lambda: registered.report(name)(spark, sf_dir)) for name in reports.REPORTS
    }
    separate = ["q04", "q05", "q06", "q07", "q08"]
    result = {
        "metric": "19 reports on the published merged table, total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "sf": scale_factor(sf_dir),
        "cpus": cpus,
        "rows": variants.count(),
        "stored_mb": round(stored_size(spark, path).first().total_bytes / 1024 / 1024, 1),
        "build_sec": round(build, 3),
        "first_pass_sec": round(sum(cold.values()), 3),
        "from_base_sec": round(sum(base.values()), 3),
        "from_base": base,
        "share_two_scans_sec": timed(lambda: two_scan_share(variants)),
        "share_one_scan_sec": timed(suite["q01_af_range_share"]),
        "sex_reports_separate_sec": round(sum(v for n, v in warm.items() if n[:3] in separate), 3),
        "sex_reports_one_scan_sec": timed(lambda: reports.sex_difference_overview(variants)),
        "eas_reports_separate_sec": round(
            sum(v for n, v in warm.items() if n[4:12] == "eas_only"), 3
        ),
        "eas_reports_one_scan_sec": timed(lambda: reports.east_asian_difference_overview(variants)),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
