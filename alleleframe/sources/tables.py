"""Text, Parquet and catalog scans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

# The chromosomes a genome release is split into.
CHROMOSOMES = [str(n) for n in range(1, 23)] + ["X", "Y"]


def read_tsv(
    spark: SparkSession,
    paths: str | Sequence[str],
    null_value: str | None = None,
    check_headers: bool = True,
) -> DataFrame:
    """Tab-separated files with a header, every column a string.

    All shards are one scan. Columns go by position in text files, so
    ``check_headers`` makes a shard with another header fail instead of mixing
    values. ``null_value="."`` reads the usual missing mark as NULL.
    """
    reader = (
        spark.read.option("sep", "\t")
        .option("header", "true")
        .option("inferSchema", "false")
        .option("enforceSchema", str(not check_headers).lower())
    )
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One scan over one or many Parquet folders.

    Columns of many folders are matched by name, whatever their order. Folders
    whose names or types differ raise; Spark alone would take the columns of one.
    """
    if isinstance(paths, str):
        return spark.read.parquet(paths)
    schemas = {path: spark.read.parquet(path).schema for path in paths}
    first, schema = next(iter(schemas.items()))
    kinds = lambda s: {f.name: f.dataType for f in s}
    for path, other in schemas.items():
        if kinds(other) != kinds(schema):
            raise ValueError(f"columns of {path} differ from those of {first}")
    return spark.read.schema(schema).parquet(*paths)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def shard_names(pattern: str) -> list[str]:
    """``"variants_chr{}"`` to one name per chromosome."""
    return [pattern.format(chromosome) for chromosome in CHROMOSOMES]


def union_shards(shards: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; shards whose columns differ raise."""
    return reduce(lambda left, right: left.unionByName(right), shards)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name ``df`` for SQL text in this session."""
    df.createOrReplaceTempView(name)
    return df
