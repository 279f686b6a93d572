"""Joins of variants with their annotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alleleframe.functions.columns import (
    absolute_difference,
    fixed_width_bin,
    quoted,
    signed_difference,
)
from alleleframe.operators.reshape import (
    MERGE_KEYS,
    VARIANT_KEYS,
    annotation_columns,
    frequency_columns,
)
from alleleframe.session import scratch_path

# Rows of one key that a task joins without being split, in bytes before compression.
TASK_BYTES = 256 * 1024 * 1024
# Key hashes, 8 bytes each, that every executor may hold to route rows without a shuffle. At
# TASK_BYTES per key, 250 TB of rows have fewer hot keys.
_BROADCAST_KEYS = 1_000_000
# Groups of key hashes that are counted before single keys are: a small table in every task.
_COUNT_BUCKETS = 65_536
# Bytes a value is taken to have, by type; others count as 64.
_VALUE_BYTES = {"boolean": 1, "int": 4, "float": 4, "bigint": 8, "double": 8, "string": 32}


def derive_frequency_columns(variants: DataFrame) -> DataFrame:
    """Frequency bin and the difference between the sexes, signed and absolute."""
    xx, xy = F.col("INFO_AF_XX"), F.col("INFO_AF_XY")
    return variants.select(
        "*",
        fixed_width_bin(F.col("INFO_AF")).alias("info_af_range"),
        signed_difference(xx, xy).alias("AF_XX_MINUS_AF_XY"),
        absolute_difference(xx, xy).alias("AF_XX_MINUS_AF_XY_ABS"),
    )


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[quoted(k) for k in keys])


def row_bytes(df: DataFrame) -> int:
    """Bytes a row is taken to have before compression, from its types."""
    return sum(_VALUE_BYTES.get(kind, 64) for _, kind in df.dtypes)


def hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_task: int | None = None
) -> DataFrame | None:
    """Hashes (``_hash``) of the keys that hold more rows than one task should join.

    By default that is ``TASK_BYTES`` of rows of ``df``. Rows are first counted
    per bucket of hashes, which shuffles next to nothing; only in buckets with
    more rows than that can a key have as many, and only there are single hashes
    counted. The result is kept in the shared folder as a table, of any number of
    keys, and is None if there is none. It only chooses a route for rows, so keys
    that share a hash do no harm.
    """
    if rows_per_task is None:
        rows_per_task = max(1, TASK_BYTES // row_bytes(df))
    spark = df.sparkSession
    hashes = df.select(*map(quoted, keys)).dropna().select(key_hash(keys).alias("_hash"))
    hashes = hashes.withColumn("_bucket", F.pmod("_hash", F.lit(_COUNT_BUCKETS)))

    def frequent(rows: DataFrame, column: str) -> DataFrame | None:
        path = scratch_path(spark, "hot-keys")
        counts = rows.groupBy(column).count()
        counts.filter(F.col("count") > rows_per_task).select(column).write.parquet(path)
        found = spark.read.schema(f"{column} bigint").parquet(path)
        return None if found.isEmpty() else found

    full = frequent(hashes, "_bucket")
    if full is None:
        return None
    return frequent(hashes.join(F.broadcast(full), "_bucket", "left_semi"), "_hash")


def broadcast_if_few(hot: DataFrame) -> DataFrame:
    """Key hashes, marked to be broadcast unless they are more than an executor should hold."""
    return F.broadcast(hot) if hot.count() <= _BROADCAST_KEYS else hot


def left_join_on_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame | None = None
) -> DataFrame:
    """Left outer equi-join; repeated right keys multiply rows.

    Adaptive execution can split a hot partition of the left side of an outer
    join but not of its right side. Rows whose key hash is in ``hot`` therefore
    go through an inner join, where both sides can be split, and through an anti
    join against the distinct hot keys, which restores unmatched rows. Rows are
    routed where they are read, as a shuffle by hash would bring a hot key into
    one task; only more than ``_BROADCAST_KEYS`` hot keys are not broadcast.
    """
    keys = list(keys)
    for key in keys:
        if left.schema[key].dataType != right.schema[key].dataType:
            raise TypeError(f"key {key} has different types on the two sides; cast it at ingest")
    if hot is None:
        return left.join(right, keys, "left")

    listed = broadcast_if_few(hot)

    def routed(df: DataFrame, kind: str) -> DataFrame:
        return df.withColumn("_hash", key_hash(keys)).join(listed, "_hash", kind).drop("_hash")

    left_hot, right_hot = routed(left, "left_semi"), routed(right, "left_semi")
    cold = routed(left, "left_anti").join(routed(right, "left_anti"), keys, "left")
    matched = left_hot.join(right_hot, keys, "inner")
    unmatched = left_hot.join(right_hot.select(*map(quoted, keys)).distinct(), keys, "left_anti")
    return cold.unionByName(matched).unionByName(unmatched, allowMissingColumns=True)


def merge_annotations(
    variants: DataFrame, annotations: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Variants that passed all filters, with every annotation that shares their key."""
    left = variants.filter(F.col("filters") == "PASS").select(
        *[quoted(old).alias(new) for old, new in zip(VARIANT_KEYS, MERGE_KEYS)],
        *[quoted(c) for c in frequency_columns(variants.columns)],
    )
    right = annotations.select(
        *MERGE_KEYS, *[quoted(c) for c in annotation_columns(annotations.columns)]
    )
    return left_join_on_keys(left, right, MERGE_KEYS, hot)


def join_genes(
    variants: DataFrame, genes: DataFrame, variant_key: str = "genename", gene_key: str = "Gene_name"
) -> DataFrame:
    """Inner join on gene name; the measured size decides broadcast or shuffle."""
    return variants.join(genes, quoted(variant_key) == quoted(gene_key), "inner")
