"""Typed warehouse tables: derived text widths, bulk load, load check."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.functions.columns import quoted
from alleleframe.operators.filters import MAX_TEXT_LENGTH
from alleleframe.session import delete_folder, held_settings
from alleleframe.sinks.statistics import collect_statistics, column_statistics
from alleleframe.sinks.storage import (
    TARGET_FILE_MB,
    cluster_files,
    clustering,
    table_detail,
)

_SPARE_CHARACTERS = 5


def text_width_profile(df: DataFrame) -> DataFrame:
    """``column_name, max_length, width`` of every string column, in one pass."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    longest = df.agg(*[F.max(F.length(quoted(n))).alias(n) for n in names])
    entries = F.array(
        *[F.struct(F.lit(n).alias("column_name"), quoted(n).alias("max_length")) for n in names]
    )
    width = F.least(F.col("max_length") + _SPARE_CHARACTERS, F.lit(MAX_TEXT_LENGTH))
    return longest.select(F.inline(entries)).withColumn(
        "width", F.coalesce(width, F.lit(MAX_TEXT_LENGTH))
    )


def stored_widths(spark: SparkSession, table: str, rows: int | None = None) -> dict[str, int]:
    """Widths of text columns from the statistics of a catalog table, where it has them.

    With ``rows``, statistics of another number of rows are stale and not used.
    """
    counted = (table_detail(spark, table, "Statistics") or "").split(", ")[-1]
    if rows is not None and counted != f"{rows} rows":
        return {}
    names = [f.name for f in spark.table(table).schema if isinstance(f.dataType, T.StringType)]
    stored = column_statistics(spark, table, names).collect()
    return {
        row.column_name: min(int(row.max_col_len) + _SPARE_CHARACTERS, MAX_TEXT_LENGTH)
        for row in stored
        if row.max_col_len is not None
    }


def warehouse_types(df: DataFrame, widths: dict[str, int] | None = None) -> dict[str, str]:
    """Column types of a warehouse table able to hold ``df``.

    Text columns whose width is not given are measured in one pass.
    """
    widths = dict(widths or {})
    unknown = [
        f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in widths
    ]
    if unknown:
        measured = text_width_profile(df.select(*map(quoted, unknown))).collect()
        widths |= {row.column_name: row.width for row in measured}
    types = {}
    for field in df.schema:
        if isinstance(field.dataType, T.StringType):
            types[field.name] = f"VARCHAR({widths[field.name]})"
        elif isinstance(field.dataType, T.DoubleType):
            types[field.name] = "FLOAT8"
        else:
            types[field.name] = field.dataType.simpleString().upper()
    return types


def swap_table(spark: SparkSession, fresh: str, table: str) -> str | None:
    """Give ``table`` the files and columns of ``fresh``; returns where the old files are.

    Both steps only change the catalog. If the second one fails, the first is undone.
    """
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        return None
    location, old = table_detail(spark, table, "Location"), f"{fresh}_old"
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {old}")
    return location


def create_typed_table(
    df: DataFrame,
    table: str,
    path: str,
    keys: Sequence[str] = (),
    widths: dict[str, int] | None = None,
    target_mb: int = TARGET_FILE_MB,
    accept: Callable[[str], None] | None = None,
) -> DataFrame:
    """Replace ``table`` by one of bounded text columns and fill it from ``df``.

    Each load has a folder of its own below ``path``. The new table is written
    and, with ``accept``, checked beside the old one, which stays readable; only
    then the names are switched and the old load's files deleted. Spark checks
    each value against its width on write and raises if it is too long; a load
    that fails leaves the old table as it was. With ``keys``, ``df`` must be a
    Parquet scan; files are then clustered by them, with about ``target_mb`` each
    or as many rows as a task should sort.
    """
    spark = df.sparkSession
    columns = ", ".join(
        f"`{name}` {'DOUBLE' if kind == 'FLOAT8' else kind}"
        for name, kind in warehouse_types(df, widths).items()
    )
    rows, rows_per_file, settings = df, 0, {}
    if keys:
        count, rows_per_file, settings = clustering(df, target_mb)
        rows = cluster_files(df, keys, count)
    load = uuid.uuid4().hex[:12]
    fresh, folder = f"{table}_load_{load}", f"{path.rstrip('/')}/load-{load}"
    spark.sql(f"CREATE TABLE {fresh} ({columns}) USING parquet LOCATION '{folder}'")
    try:
        # insertInto takes no option for the files of a catalog table, but the setting holds.
        with held_settings(spark, settings | {"spark.sql.files.maxRecordsPerFile": rows_per_file}):
            rows.write.insertInto(fresh, overwrite=True)
        if accept:
            accept(fresh)
        old = swap_table(spark, fresh, table)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        delete_folder(spark, folder)
        raise
    if old and f"{path.rstrip('/')}/load-" in old:
        delete_folder(spark, old)
    return spark.read.table(table)


def load_checked(
    spark: SparkSession, source: str, table: str, path: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Load Parquet files or a table into a typed, clustered and analysed table.

    The source is tested first. Widths come from the source's statistics if it is
    a table that has them for as many rows as it holds. The new rows are counted
    and analysed before they take the old table's place: an empty source, a value
    that is too long and a missing row all raise and leave the old table as it is.
    """
    stored = "/" not in source
    df = spark.read.table(source) if stored else spark.read.parquet(source)
    rows = df.count()
    if not rows:
        raise RuntimeError(f"data load failed for {table}: {source} is empty")
    widths = stored_widths(spark, source, rows) if stored else None

    def accept(fresh: str) -> None:
        if spark.read.table(fresh).count() != rows:
            raise RuntimeError(f"data load failed for {table}: rows are missing")
        collect_statistics(spark, fresh)

    return create_typed_table(df, table, path, keys, widths, accept=accept)
