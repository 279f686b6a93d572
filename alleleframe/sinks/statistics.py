"""Column statistics: of catalog tables for the cost-based optimizer, and per shard to be merged.

Statistics of shards are a table: one row per shard and column with counts,
widths, extremes and a sketch of the distinct values. Those of a whole table are
a merge of these rows, so a new or replaced shard is the only thing to be read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.functions.columns import quoted

STATISTICS = ("min", "max", "num_nulls", "distinct_count", "max_col_len")
_COMPLEX = (T.StructType, T.ArrayType, T.MapType)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def collect_statistics(
    spark: SparkSession, table: str, columns: Sequence[str] | None = None
) -> list[str]:
    """Analyze all (or the named) columns that can have statistics."""
    schema = spark.table(table).schema
    wanted = [
        f.name
        for f in schema
        if not isinstance(f.dataType, _COMPLEX) and (columns is None or f.name in set(columns))
    ]
    spark.sql(
        f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(map(_quote, wanted))}"
    )
    return wanted


def column_statistics(spark: SparkSession, table: str, columns: Sequence[str]) -> DataFrame:
    """Stored statistics, one row per column; reads the catalog, not the data."""
    entries = []
    for name in columns:
        described = spark.sql(f"DESCRIBE EXTENDED {table} {_quote(name)}").collect()
        stored = {r.info_name: None if r.info_value == "NULL" else r.info_value for r in described}
        entries.append((name, *[stored.get(s) for s in STATISTICS]))
    schema = ", ".join(f"{c} string" for c in ("column_name", *STATISTICS))
    return spark.createDataFrame(entries, schema)


#: Logarithm of a sketch's size: the standard error of a count is 1.04 / sqrt(2^14), below 0.9 %.
SKETCH_BITS = 14


def shard_statistics(df: DataFrame, shard: str, columns: Sequence[str] | None = None) -> DataFrame:
    """shard, column_name, rows, nulls, max_length, min, max, sketch; one pass over ``df``.

    Extremes are texts, ordered by the column's own type; lengths are those of
    text columns. A row with a NULL in ``shard`` belongs to a shard of its own.
    """
    fields = [
        f
        for f in df.schema
        if not isinstance(f.dataType, _COMPLEX)
        and f.name != shard
        and (columns is None or f.name in set(columns))
    ]
    figures = [F.count("*").alias("rows")]
    entries = []
    for i, field in enumerate(fields):
        value = quoted(field.name)
        text = isinstance(field.dataType, T.StringType)
        figures += [
            F.count(value).alias(f"n{i}"),
            F.max(F.length(value) if text else F.lit(None).cast("int")).alias(f"l{i}"),
            F.min(value).cast("string").alias(f"a{i}"),
            F.max(value).cast("string").alias(f"z{i}"),
            F.hll_sketch_agg(value.cast("string"), SKETCH_BITS).alias(f"s{i}"),
        ]
        entries.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col("rows"),
                (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
                F.col(f"l{i}").cast("bigint").alias("max_length"),
                F.col(f"a{i}").alias("min"),
                F.col(f"z{i}").alias("max"),
                F.col(f"s{i}").alias("sketch"),
            )
        )
    by_shard = df.groupBy(quoted(shard).cast("string").alias("shard")).agg(*figures)
    return by_shard.select("shard", F.inline(F.array(*entries)))


def with_new_shards(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """``stored`` shard statistics with those of ``fresh`` in place of the same shards."""
    new = fresh.select(F.col("shard").alias("_new")).distinct()
    kept = stored.join(new, F.col("shard").eqNullSafe(F.col("_new")), "left_anti")
    return kept.unionByName(fresh)


def merged_statistics(shards: DataFrame) -> DataFrame:
    """column_name, rows, nulls, max_length, min, max, distinct_estimate of all shards together.

    All figures but ``distinct_estimate`` are exact. Extremes of numbers are
    compared as numbers.
    """
    numeric = F.col("type").isin("tinyint", "smallint", "int", "bigint", "float", "double") | F.col(
        "type"
    ).startswith("decimal")
    # Integers as decimals: a double does not tell large ones apart.
    whole = F.col("type").isin("tinyint", "smallint", "int", "bigint") | F.col("type").startswith("decimal")
    figures = []
    for name, of, by in (("min", F.min, F.min_by), ("max", F.max, F.max_by)):
        exact = F.when(whole, F.col(name).try_cast("decimal(38,18)"))
        double = F.when(numeric, F.col(name).try_cast("double"))
        figures.append(
            F.coalesce(by(name, exact), by(name, double), of(F.when(~numeric, F.col(name)))).alias(name)
        )
    return shards.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.max("max_length").alias("max_length"),
        *figures,
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
    )
