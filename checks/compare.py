"""Run registered queries and their oracle SQL side by side.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks import oracles, registered


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and its oracle; empty if nothing."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(result.columns) != sorted(names):
        return [f"columns {sorted(result.columns)} and {sorted(names)}"]
    ours = _rows(result.columns, result.collect())
    theirs = _rows(names, expected.fetchall())
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows and {len(theirs)}"]
    if not ours:
        return ["no rows on either side"]
    return [f"{a} and {b}" for a, b in zip(ours, theirs) if repr(a) != repr(b)][:3]


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = registered.all_queries(), oracles.all_sql()
    failed = 0
    for name in names or queries:
        started = time.time()
        try:
            if name in sql:
                found = differences(queries[name](spark, sf_dir), con, sql[name])
            else:
                count = queries[name](spark, sf_dir).count()
                found = [] if count else ["no rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        state = "DIFFERS" if found else ("equal" if name in sql else "rows only")
        print(f"{name:34s} {state:9s} {time.time() - started:6.2f}s", *found, sep="\n   ", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
