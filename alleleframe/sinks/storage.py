"""Parquet output: plain, as external tables, and clustered by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alleleframe.functions.columns import quoted
from alleleframe.operators.annotate import row_bytes
from alleleframe.session import drop_scratch, held_settings, scratch_path, setting_bytes

TARGET_FILE_MB = 256
CODEC = "snappy"
# Ranges of one clustered write, at most: each may hold several files.
MOST_RANGES = 30_000
# Rows that one task of a clustered write sorts or deals out, in bytes before compression.
RANGE_BYTES = 512 * 1024 * 1024
# Tasks that deal out rows, at most, unless the session's own splits are more.
_MOST_SPLITS = 100_000
# Row groups of a staged copy, encoded: what a split can be as small as.
_STAGED_GROUP_BYTES = 16 * 1024 * 1024
_BYTES_PER_MB = 1024 * 1024


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    codec: str = CODEC,
    rows_per_file: int = 0,
    only_own_shards: bool = False,
    group_bytes: int | None = None,
) -> None:
    """Overwrite ``path`` with Parquet files; a task starts a new file after ``rows_per_file`` rows.

    ``only_own_shards`` replaces only the ``partition_by`` folders that ``df`` has rows for.
    ``group_bytes`` bounds the row groups, which a later scan cannot split.
    """
    writer = df.write.mode("overwrite").option("compression", codec)
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    writer = writer.option("partitionOverwriteMode", "dynamic" if only_own_shards else "static")
    writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_external_table(
    df: DataFrame,
    table: str,
    path: str,
    partition_by: Sequence[str] = (),
    codec: str = CODEC,
    rows_per_file: int = 0,
) -> DataFrame:
    """Overwrite a catalog table whose files live at ``path``; return its scan."""
    writer = df.write.mode("overwrite").format("parquet").option("compression", codec)
    writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table, path=path)
    return df.sparkSession.read.table(table)


def stored_size(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row with the total bytes of all files below ``paths``.

    Only file listings are read: ``length`` is metadata of the binary source.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load([paths] if isinstance(paths, str) else list(paths))
        .agg(F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
    )


def scan_size(df: DataFrame) -> tuple[int, int]:
    """Bytes of the files of a Parquet scan, and its rows.

    Only footers are read, file names stay on the executors, and one row comes back.
    """
    files = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("rows")
    )
    found = files.agg(F.sum("bytes"), F.sum("rows")).first()
    return found[0] or 0, found[1] or 0


def table_detail(spark: SparkSession, table: str, name: str) -> str | None:
    """One line of a table's description, such as ``Location`` or ``Statistics``."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == name)
    row = described.first()
    return row.data_type if row else None


def source_bytes(spark: SparkSession, names: Sequence[str]) -> int:
    """Bytes of Parquet paths (names with a ``/``) and catalog tables, from file listings."""
    paths = [n if "/" in n else table_detail(spark, n, "Location") for n in names]
    return stored_size(spark, paths).first().total_bytes


def target_file_count(total_bytes: int, target_mb: int = TARGET_FILE_MB) -> int:
    return max(int(total_bytes / _BYTES_PER_MB / target_mb), 1)


def range_layout(
    total_bytes: int, rows: int, target_mb: int = TARGET_FILE_MB, bytes_per_row: int = 0
) -> tuple[int, int]:
    """Number of key ranges and rows per file for files of about ``target_mb``.

    One range per file while these are few. Beyond ``MOST_RANGES``, a range holds
    several files, cut by row count, so that a shuffle of 100 TB has some ten
    thousand reducers, sorted outside of memory, and not one per file. A range is
    one task, so rows of ``bytes_per_row`` that compress well are cut into ranges
    of ``RANGE_BYTES``, and files are smaller than ``target_mb``.
    """
    files = target_file_count(total_bytes, target_mb)
    needed = min(-(-rows * bytes_per_row // RANGE_BYTES), MOST_RANGES)
    if files <= MOST_RANGES:
        return max(files, needed), 0
    per_range = -(-files // MOST_RANGES)
    return max(-(-files // per_range), needed), max(1, rows // files)


def split_bytes(total_bytes: int, rows: int, bytes_per_row: int) -> int:
    """Bytes of files whose rows are ``RANGE_BYTES`` before compression.

    A task that deals rows out to hundreds of ranges holds all rows of its split.
    """
    wanted = total_bytes * RANGE_BYTES // max(rows * bytes_per_row, 1)
    return max(wanted, total_bytes // _MOST_SPLITS, 4 * _BYTES_PER_MB)


def clustering(df: DataFrame, target_mb: int = TARGET_FILE_MB) -> tuple[int, int, dict[str, int]]:
    """Ranges and rows per file for a Parquet scan, and the settings to read it under."""
    total, rows = scan_size(df)
    count, rows_per_file = range_layout(total, rows, target_mb, row_bytes(df))
    name = "spark.sql.files.maxPartitionBytes"
    split = min(setting_bytes(df.sparkSession, name), split_bytes(total, rows, row_bytes(df)))
    return count, rows_per_file, {name: split}


def cluster_files(df: DataFrame, keys: Sequence[str], count: int) -> DataFrame:
    """``df`` in ``count`` key ranges of similar size, each sorted by key.

    Concatenated, the ranges are globally sorted by ``keys``. ``df`` must be a
    Parquet scan: the position of a row in its file joins the range key, so
    rows of one hot key, exact copies included, spread over several ranges.
    That position is the same when a lost task runs again, which a random salt
    is not.
    """
    return (
        df.select("*", F.col("_metadata.row_index").alias("_row"))
        .repartitionByRange(count, *[quoted(k) for k in keys], F.col("_row"))
        .sortWithinPartitions(*[quoted(k) for k in keys])
        .drop("_row")
    )


def replace_shards(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    shards: Sequence[Sequence] | None = None,
    target_mb: int = TARGET_FILE_MB,
    codec: str = CODEC,
) -> DataFrame:
    """Replace the folders of a partitioned table that ``df`` has rows for; others keep their files.

    Such as one chromosome of a release. ``shards`` lists the values of
    ``partition_by`` that may be replaced; rows of any other raise before a file
    is touched. The new files are clustered by ``keys`` like those of
    ``write_clustered``, and the old ones go only after all new ones are written.
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "stage")
    try:
        write_parquet(df, staged, codec=codec, group_bytes=_STAGED_GROUP_BYTES)
        copy = spark.read.parquet(staged)
        if shards is not None:
            # One row per folder.
            found = {tuple(r) for r in copy.select(*map(quoted, partition_by)).distinct().collect()}
            others = found - {tuple(s) for s in shards}
            if others:
                raise ValueError(f"rows of shards that are not to be replaced: {sorted(others, key=repr)}")
        count, rows_per_file, settings = clustering(copy, target_mb)
        clustered = cluster_files(copy, [*partition_by, *keys], count)
        with held_settings(spark, settings):
            write_parquet(clustered, path, partition_by, codec, rows_per_file, only_own_shards=True)
        return spark.read.parquet(path)
    finally:
        drop_scratch(spark, staged)


def write_clustered(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    table: str | None = None,
    partition_by: Sequence[str] = (),
    target_mb: int = TARGET_FILE_MB,
    codec: str = CODEC,
) -> DataFrame:
    """Write ``df`` clustered by ``keys`` into files of about ``target_mb``.

    Files are smaller where their rows would be more than a task should sort.
    ``df`` is first written once, unsorted, to the shared scratch folder. This
    gives the compressed size that sets the file count, and it keeps the
    sampling pass of the range partitioning from running the parse or join
    behind ``df`` a second time; a lost executor restarts from there too. The
    staged copy is deleted once the result is written, or when the write fails.
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "stage")
    try:
        write_parquet(df, staged, codec=codec, group_bytes=_STAGED_GROUP_BYTES)
        copy = spark.read.parquet(staged)
        count, rows_per_file, settings = clustering(copy, target_mb)
        clustered = cluster_files(copy, keys, count)
        with held_settings(spark, settings):
            if table:
                save_external_table(clustered, table, path, partition_by, codec, rows_per_file)
            else:
                write_parquet(clustered, path, partition_by, codec, rows_per_file)
        return spark.read.table(table) if table else spark.read.parquet(path)
    finally:
        drop_scratch(spark, staged)
