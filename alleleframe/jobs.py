"""Command line for spark-submit: ingest, merge and report.

    spark-submit alleleframe/jobs.py variants --input 'gs://b/chr*.vcf.gz' --output gs://b/variants
    spark-submit alleleframe/jobs.py annotations --input 'gs://b/ann/*.tsv' --output gs://b/ann.parquet
    spark-submit alleleframe/jobs.py genes --input gs://b/genes.tsv --output gs://b/genes.parquet
    spark-submit alleleframe/jobs.py merge --variants gs://b/variants --annotations gs://b/ann.parquet \\
        --output gs://b/merged
    spark-submit alleleframe/jobs.py reports --merged gs://b/merged --genes gs://b/genes.parquet

A source with a ``/`` is a Parquet path, anything else a catalog table. A table
name with ``{}`` stands for one table per chromosome. ``--hive`` keeps tables in
a Hive catalog.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from alleleframe.operators import metering  # noqa: E402
from alleleframe.plans import ingest, reports  # noqa: E402
from alleleframe.session import session_builder, size_shuffles  # noqa: E402
from alleleframe.sinks import warehouse  # noqa: E402
from alleleframe.sinks.storage import (  # noqa: E402
    CODEC,
    TARGET_FILE_MB,
    replace_shards,
    source_bytes,
    stored_size,
)
from alleleframe.sources import tables  # noqa: E402


def source_names(name: str) -> list[str]:
    return tables.shard_names(name) if "{}" in name else [name]


def open_source(spark: SparkSession, name: str) -> DataFrame:
    if "{}" in name:
        names = tables.shard_names(name)
        if "/" in name:
            return tables.read_parquet(spark, names)
        return tables.union_shards([tables.read_table(spark, n) for n in names])
    return tables.read_parquet(spark, name) if "/" in name else tables.read_table(spark, name)


def layout(args: argparse.Namespace) -> dict:
    return {"target_mb": args.target_mb, "partition_by": args.partition_by, "codec": args.codec}


def convert_variants(spark: SparkSession, args: argparse.Namespace) -> None:
    flat = ingest.variants_from_vcf(
        spark,
        args.input,
        header=args.header,
        fields=args.fields,
        one_based=not args.zero_based,
        align="declared" if args.align == ["declared"] else args.align,
        block_gzip_files=args.block_gzip or None,
    )
    ingest.publish_variants(flat, args.output, args.table, **layout(args))


def convert_annotations(spark: SparkSession, args: argparse.Namespace) -> None:
    annotations = ingest.annotations_from_tsv(spark, args.input, null_value=args.null_value)
    ingest.publish_annotations(annotations, args.output, args.table, **layout(args))


def convert_genes(spark: SparkSession, args: argparse.Namespace) -> None:
    genes = ingest.genes_from_tsv(
        spark, args.input, keep_nulls=args.keep_nulls or None, null_value=args.null_value
    )
    ingest.publish_genes(genes, args.output, args.table, **layout(args))


def merge(spark: SparkSession, args: argparse.Namespace) -> None:
    variants, annotations = open_source(spark, args.variants), open_source(spark, args.annotations)
    names = [*source_names(args.variants), *source_names(args.annotations)]
    size_shuffles(spark, source_bytes(spark, names))
    merged = ingest.merged_variants(variants, annotations)
    ingest.publish_annotations(merged, args.output, args.table, **layout(args))


def replace_chromosomes(spark: SparkSession, args: argparse.Namespace) -> None:
    """Replace the named chromosomes of a table that is stored by chromosome."""
    df = open_source(spark, args.source)
    column = args.partition_by[0]
    kept = [c for c in args.keys if c != column]
    replace_shards(
        df, args.output, kept, [column], [(c,) for c in args.shards], args.target_mb, args.codec
    )


def run_reports(spark: SparkSession, args: argparse.Namespace) -> None:
    """Print every report, then what the runs read and took; a full run scans once per difference family.

    ``--run-log`` keeps the runs as a table.
    """
    merged, genes = open_source(spark, args.merged), open_source(spark, args.genes)
    runs = []

    def collect(df: DataFrame, name: str) -> list:
        rows, run = metering.run_measured(df, name)
        runs.append(run)
        return rows

    shared = {} if args.only else reports.difference_suite(merged, collect)
    for name in args.only or reports.REPORTS:
        print(name)
        report = shared[name] if name in shared else reports.REPORTS[name](merged, genes)
        rows = collect(report, name)
        spark.createDataFrame(rows, report.schema).show(100, truncate=False)
    log = metering.runs_table(spark, runs)
    if args.run_log:
        metering.append_runs(spark, runs, args.run_log)
    costs = metering.scan_cost_report(log, args.rate_per_tb)
    costs.select("name", "rows_read", "rows_out", "gb_processed", "cost", "runtime").show(100, truncate=False)
    metering.runtime_totals(costs).show(truncate=False)


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    loaded = warehouse.load_checked(spark, args.source, args.table, args.output, args.keys)
    print(f"{args.table}: {loaded.count()} rows")


def storage(spark: SparkSession, args: argparse.Namespace) -> None:
    metering.storage_cost(stored_size(spark, args.path), args.rate).show(truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="alleleframe")
    top.add_argument("--hive", action="store_true", help="use a Hive catalog")
    commands = top.add_subparsers(dest="command", required=True)

    def writer(name, run):
        command = commands.add_parser(name)
        command.add_argument("--output", required=True)
        command.add_argument("--table")
        command.add_argument("--target-mb", type=int, default=TARGET_FILE_MB)
        command.add_argument("--partition-by", nargs="+", default=[], help="folder columns")
        command.add_argument("--codec", default=CODEC, help="Parquet compression")
        command.set_defaults(run=run)
        return command

    def converter(name, run):
        command = writer(name, run)
        command.add_argument("--input", nargs="+", required=True)
        return command

    variants = converter("variants", convert_variants)
    variants.add_argument("--header", help="file with the VCF header; default: each input's own")
    variants.add_argument("--fields", nargs="+", help="INFO fields to keep; default: all")
    variants.add_argument("--zero-based", action="store_true")
    variants.add_argument(
        "--align",
        nargs="*",
        help="arrays with a value per allele, such as INFO_AF; 'declared': by the header; default: all",
    )
    variants.add_argument("--block-gzip", action="store_true", help=".gz inputs are block-gzip: split them")
    annotations = converter("annotations", convert_annotations)
    annotations.add_argument("--null-value", help="text that means missing, such as .")
    genes = converter("genes", convert_genes)
    genes.add_argument("--null-value")
    genes.add_argument("--keep-nulls", action="store_true")

    merger = writer("merge", merge)
    merger.add_argument("--variants", required=True)
    merger.add_argument("--annotations", required=True)

    replacer = writer("replace", replace_chromosomes)
    replacer.add_argument("--source", required=True, help="new rows, only of the named shards")
    replacer.add_argument("--shards", nargs="+", required=True, help="values such as chr21")
    replacer.add_argument("--keys", nargs="+", default=["start_position"], help="columns to cluster by")
    replacer.set_defaults(partition_by=["chromosome"])

    reporter = commands.add_parser("reports")
    reporter.add_argument("--merged", required=True)
    reporter.add_argument("--genes", required=True)
    reporter.add_argument("--run-log", help="folder of a run log to add to")
    reporter.add_argument("--rate-per-tb", type=float, default=metering.ATHENA_PER_TB)
    reporter.add_argument("--only", nargs="+", choices=list(reports.REPORTS))
    reporter.set_defaults(run=run_reports)

    loader = commands.add_parser("load", help="into a typed, clustered and analysed table")
    loader.add_argument("--source", required=True)
    loader.add_argument("--table", required=True)
    loader.add_argument("--output", required=True)
    loader.add_argument("--keys", nargs="+", default=[], help="columns to cluster by")
    loader.set_defaults(run=load)

    sizer = commands.add_parser("storage")
    sizer.add_argument("--path", nargs="+", required=True)
    sizer.add_argument("--rate", type=float, default=metering.BIGQUERY_STORAGE_PER_GB_MONTH)
    sizer.set_defaults(run=storage)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = session_builder(f"alleleframe {args.command}", hive=args.hive).getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
