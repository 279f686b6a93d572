"""Reading tables, staging intermediate results and normalising text."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alleleframe.functions.columns import quoted
from alleleframe.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps read the table instead of repeating the work behind it, also
    when an executor is lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def shuffle_width(spark: SparkSession, rows: int, per_task: int) -> int:
    """Tasks so that each gets about ``per_task`` rows, at least the session's number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def one_per_class(docs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: exactly one of each class.

    ``found`` has doc_id, text_hash, class and kept of the rows that have a class.
    Where several rows of a class are kept, because they repeat its id or because
    none has an id, the smallest text hash decides, and between rows that repeat id
    and text their other columns. Only such rows are grouped, with partial groups
    before the shuffle.
    """
    found = staged(
        found.groupBy("class", "doc_id", "text_hash", "kept").agg(F.count("*").alias("n")), f"{name}-classes"
    )
    tied = (
        found.where("kept")
        .groupBy("class")
        .agg(F.sum("n").alias("n"), F.min(F.struct("text_hash", "doc_id")).alias("stays"))
        .where("n > 1")
    )
    tied = staged(tied.select("class", "stays.*"), f"{name}-tied")
    apart = found.where("NOT kept").select("doc_id", "text_hash")
    apart = apart.unionByName(
        found.where("kept").join(tied.select("class"), "class", "left_semi").select("doc_id", "text_hash")
    )
    apart = staged(apart, f"{name}-apart")
    rest = [quoted(c) for c in docs.columns if c != "text"]
    row = docs.select(
        F.struct("*").alias("row"),
        F.to_json(F.struct(*rest)).alias("rest"),
        "doc_id",
        F.xxhash64(whole_text()).alias("text_hash"),
    )

    def those(keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"))
        same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
        return row.join(keys, same, how)

    one = those(tied, "left_semi").groupBy("doc_id", "text_hash").agg(F.min_by("row", "rest").alias("row"))
    return those(apart, "left_anti").select("row.*").unionByName(one.select("row.*"))
