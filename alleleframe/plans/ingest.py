"""From raw files to the merged table: one plan and one clustered write each."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alleleframe.operators.annotate import (
    derive_frequency_columns,
    hot_keys,
    merge_annotations,
)
from alleleframe.operators.filters import within_length
from alleleframe.operators.reshape import (
    MERGE_KEYS,
    VARIANT_KEYS,
    clean_names,
    explode_alternates,
    explode_by_number,
    flatten_structs,
    numeric_position,
    prefix_values,
    rename_columns,
)
from alleleframe.sinks.statistics import collect_statistics
from alleleframe.sinks.storage import write_clustered
from alleleframe.sources.tables import read_tsv
from alleleframe.sources.vcf import declared_fields, read_vcf

GENE_KEYS = ["Gene_name"]


def variants_from_vcf(
    spark: SparkSession,
    paths: str | Sequence[str],
    align: Sequence[str] | str | None = None,
    header: str | Iterable[str] | None = None,
    **options,
) -> DataFrame:
    """Flat variants, one row per alternate allele; ``options`` go to ``read_vcf``.

    ``align`` names the arrays with a value per allele; other arrays stay whole.
    ``align="declared"`` takes it from the header instead: arrays declared per
    alternate, per allele or per genotype are cut to the alternate of the row.
    ``filters`` that stay whole become text, joined by ``;``, so that a record's
    filter holds for all its alternates.
    """
    if align != "declared":
        flat = explode_alternates(flatten_structs(read_vcf(spark, paths, header, **options)), align=align)
    else:
        declared = declared_fields(spark, paths, header)
        numbers = {f"INFO_{f.name}": f.number for f in declared}
        lines = [f.line for f in declared]
        flat = explode_by_number(flatten_structs(read_vcf(spark, paths, ["##", *lines], **options)), numbers)
    if align is not None and "filters" not in align:
        flat = flat.withColumn("filters", F.array_join("filters", ";"))
    return flat


def annotations_from_tsv(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Annotations with the join key named and typed like the variants'."""
    renamed = rename_columns(read_tsv(spark, paths, **options))
    return numeric_position(prefix_values(renamed, "chromosome", "chr"))


def genes_from_tsv(
    spark: SparkSession, paths: str | Sequence[str], keep_nulls: bool | None = None, **options
) -> DataFrame:
    """Genes with clean column names and only texts a warehouse can hold.

    With a ``null_value``, rows with missing texts are kept; to drop them would
    lose every gene with one missing mark, so that pair is refused.
    """
    marked = options.get("null_value") is not None
    if marked and keep_nulls is False:
        raise ValueError("null_value with keep_nulls=False drops every row with a missing text")
    keep = marked if keep_nulls is None else keep_nulls
    return within_length(clean_names(read_tsv(spark, paths, **options)), keep_nulls=keep)


def merged_variants(variants: DataFrame, annotations: DataFrame) -> DataFrame:
    """The wide table all reports read.

    One pass over the annotation keys looks for hot keys first.
    """
    hot = hot_keys(annotations, MERGE_KEYS)
    return merge_annotations(derive_frequency_columns(variants), annotations, hot)


def publish(
    df: DataFrame, path: str, keys: Sequence[str], table: str | None = None, **layout
) -> DataFrame:
    """Write ``df`` clustered by ``keys``; as a table, with statistics."""
    written = write_clustered(df, path, keys, table=table, **layout)
    if table:
        collect_statistics(df.sparkSession, table)
    return written


def publish_variants(df: DataFrame, path: str, table: str | None = None, **layout) -> DataFrame:
    return publish(df, path, VARIANT_KEYS, table, **layout)


def publish_annotations(df: DataFrame, path: str, table: str | None = None, **layout) -> DataFrame:
    return publish(df, path, MERGE_KEYS, table, **layout)


def publish_genes(df: DataFrame, path: str, table: str | None = None, **layout) -> DataFrame:
    return publish(df, path, GENE_KEYS, table, **layout)
