"""Tables bucketed by key, so that joins on that key need no shuffle.

Variants and annotations are written once in the same number of buckets of the
same key; every later join of the two reads bucket by bucket. Keys that hold more
rows than one task should join are kept apart, in a plain table beside the
bucketed one: a bucket is read by one task and cannot be split, a shuffled join
of hot keys can.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alleleframe.functions.columns import quoted
from alleleframe.operators.annotate import (
    broadcast_if_few,
    hot_keys,
    key_hash,
    merge_annotations,
    row_bytes,
)
from alleleframe.operators.reshape import MERGE_KEYS, VARIANT_KEYS
from alleleframe.session import drop_scratch, scratch_path
from alleleframe.sinks import storage
from alleleframe.sinks.storage import CODEC, target_file_count

_HOT = "_hot"


def bucket_count(total_bytes: int, target_mb: int = 256) -> int:
    """Buckets of about ``target_mb``: a power of two, so that later releases can keep the number."""
    return 1 << (target_file_count(total_bytes, target_mb) - 1).bit_length()


def buckets_for(df: DataFrame, rows: int, least: int) -> int:
    """At least ``least`` buckets: doubled until one task can sort the rows of each."""
    while least * storage.RANGE_BYTES < rows * row_bytes(df):
        least *= 2
    return least


def write_bucketed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int,
    hot: DataFrame | None = None,
    path: str | None = None,
    codec: str = CODEC,
) -> None:
    """Overwrite ``table`` by ``df`` in buckets of ``keys``, one sorted file per bucket.

    ``hot`` lists key hashes (``operators.annotate.hot_keys``); rows of these keys
    go to ``<table>_hot``, which is always written. With ``path`` both tables are
    external.
    """
    listed = None if hot is None else broadcast_if_few(hot)
    hashed = df.withColumn("_hash", key_hash(keys))
    cold = df if hot is None else hashed.join(listed, "_hash", "left_anti").drop("_hash")
    rest = df.limit(0) if hot is None else hashed.join(listed, "_hash", "left_semi").drop("_hash")
    # Rows are dealt out as buckets are, so each task writes whole buckets.
    bucketed = cold.repartition(buckets, *map(quoted, keys))
    writer = bucketed.write.mode("overwrite").option("compression", codec).format("parquet")
    writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    plain = rest.write.mode("overwrite").option("compression", codec).format("parquet")
    if path:
        writer = writer.option("path", f"{path.rstrip('/')}/cold")
        plain = plain.option("path", f"{path.rstrip('/')}/hot")
    writer.saveAsTable(table)
    plain.saveAsTable(table + _HOT)


def bucket_variants(
    variants: DataFrame, annotations: DataFrame, tables: tuple[str, str], buckets: int,
    rows_per_task: int | None = None,
) -> None:
    """Write variants and annotations as a pair of tables that join without a shuffle.

    Hot keys are those of the annotations; both tables leave out the same ones.
    ``buckets`` is the least number; large tables get more, see ``buckets_for``.
    Annotations are staged first, as they are read three times: for the hot keys,
    the rows of these and all others.
    """
    spark = variants.sparkSession
    staged = scratch_path(spark, "stage")
    try:
        storage.write_parquet(annotations, staged)
        notes = spark.read.parquet(staged)
        hot = hot_keys(notes, MERGE_KEYS, rows_per_task)
        buckets = buckets_for(variants, variants.count(), buckets_for(notes, notes.count(), buckets))
        write_bucketed(variants, tables[0], VARIANT_KEYS, buckets, hot)
        write_bucketed(notes, tables[1], MERGE_KEYS, buckets, hot)
    finally:
        drop_scratch(spark, staged)


def merge_bucketed(spark: SparkSession, variants: str, annotations: str) -> DataFrame:
    """``merge_annotations`` of two tables of ``bucket_variants``: no exchange but for hot keys.

    Every key in the hot tables is a hot key, so their join is an inner join that
    adaptive execution can split, and an anti join for what has no annotation.
    """
    cold = merge_annotations(spark.table(variants), spark.table(annotations))
    hot_variants, hot_notes = spark.table(variants + _HOT), spark.table(annotations + _HOT)
    if hot_variants.isEmpty():
        return cold
    # One hash per hot key: at most one per TASK_BYTES of annotations.
    listed = hot_notes.select(key_hash(MERGE_KEYS).alias("_hash")).distinct()
    return cold.unionByName(merge_annotations(hot_variants, hot_notes, listed))
