"""Variant, annotation and gene tables derived by Spark from the driver's tables.

``checks/oracles.py`` holds the same derivations as SQL.
"""

from __future__ import annotations

import os
import sys
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alleleframe.functions.columns import fixed_width_bin

# What runs in tasks travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _chromosome(number: Column) -> Column:
    """0..21 to 1..22, then X and Y."""
    return (
        F.when(number == 22, F.lit("X"))
        .when(number == 23, F.lit("Y"))
        .otherwise((number + 1).cast("string"))
    )


def chromosome_of(key: Column) -> Column:
    return F.concat(F.lit("chr"), _chromosome(key % 24))


def bare_chromosome_of(key: Column) -> Column:
    return _chromosome(key % 24)


def merged_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide merged table: one row per order line."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    base = lines.join(parts, lines.l_partkey == parts.p_partkey).join(
        orders, lines.l_orderkey == orders.o_orderkey
    )
    price = F.col("l_extendedprice") / F.lit(110000.0)
    tax, discount, quantity = F.col("l_tax"), F.col("l_discount"), F.col("l_quantity")
    line = F.col("l_linenumber").cast("double")
    asj = F.when(line == 7, None).otherwise(tax / 2)
    xx, xy = price + tax, price + discount
    return base.select(
        chromosome_of(F.col("l_partkey")).alias("chromosome"),
        F.col("l_orderkey").alias("start_position"),
        F.col("l_returnflag").alias("refallele"),
        F.col("l_linestatus").alias("altallele"),
        price.alias("info_af"),
        xx.alias("info_af_xx"),
        xy.alias("info_af_xy"),
        discount.alias("info_af_afr"),
        tax.alias("info_af_amr"),
        asj.alias("info_af_asj"),
        (quantity / 100).alias("info_af_eas"),
        (line / 20).alias("info_af_fin"),
        (discount * 2).alias("info_af_nfe"),
        (discount + (quantity - 25) / 400).alias("info_af_afr_xx"),
        discount.alias("info_af_afr_xy"),
        (tax + (line - 4) / 70).alias("info_af_amr_xx"),
        tax.alias("info_af_amr_xy"),
        (asj + asj).alias("info_af_asj_xx"),
        asj.alias("info_af_asj_xy"),
        (quantity / 100 + tax - discount).alias("info_af_eas_xx"),
        (quantity / 100).alias("info_af_eas_xy"),
        (line / 20 + (line - 4) / 100).alias("info_af_fin_xx"),
        (line / 20).alias("info_af_fin_xy"),
        (discount + discount / 3).alias("info_af_mid_xx"),
        discount.alias("info_af_mid_xy"),
        (discount * 2 + tax / 4).alias("info_af_nfe_xx"),
        (discount * 2).alias("info_af_nfe_xy"),
        (discount + (25 - quantity) / 600).alias("info_af_sas_xx"),
        discount.alias("info_af_sas_xy"),
        fixed_width_bin(price).alias("info_af_range"),
        (xx - xy).alias("AF_XX_MINUS_AF_XY"),
        F.abs(xx - xy).alias("AF_XX_MINUS_AF_XY_ABS"),
        F.when(F.col("p_size") % 10 == 0, None)
        .when(F.col("p_size") % 10 == 1, "")
        .otherwise(F.col("p_brand"))
        .alias("genename"),
        F.when(F.col("p_type") == "ECONOMY", "Pathogenic")
        .when(F.col("p_type") == "SMALL", "Likely_pathogenic")
        .when(F.col("p_type") == "STANDARD", "Benign")
        .when(F.col("p_type") == "PROMO", "Pathogenic|association")
        .when(F.col("p_type") == "MEDIUM", "Uncertain_significance")
        .alias("clinvar_clnsig"),
        F.col("p_name").alias("clinvar_trait"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "reviewed_by_expert_panel")
        .when(F.col("o_orderpriority") == "2-HIGH", "criteria_provided")
        .alias("clinvar_review"),
        F.concat("l_returnflag", F.lit(">"), "l_linestatus").alias("clinvar_hgvs"),
    )


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("Gene_name"))
        .agg(
            F.min("p_name").alias("gene_full_name"),
            F.max("p_type").alias("function_description"),
            F.min("p_type").alias("disease_description"),
            F.max("p_name").alias("Pathway(KEGG)_full"),
        )
    )


def nested_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants as a VCF reader returns them: 0, 1 or 2 alternates per record.

    ``l_linenumber`` 3 and 6 have no alternate, 1, 4 and 7 one, 2 and 5 two.
    """
    kind = F.col("l_linenumber") % 3
    tax, discount, price = F.col("l_tax"), F.col("l_discount"), F.col("l_extendedprice")
    per_allele = lambda one, two: (
        F.when(kind == 1, F.array(one)).when(kind == 2, F.array(one, two))
    )
    return table(spark, sf_dir, "lineitem").select(
        chromosome_of(F.col("l_partkey")).alias("contigName"),
        F.col("l_orderkey").alias("start"),
        F.col("l_returnflag").alias("referenceAllele"),
        per_allele(F.col("l_linestatus"), F.lit("T")).alias("alternateAlleles"),
        F.when(F.col("l_quantity") > 10, F.array(F.lit("PASS")))
        .otherwise(F.array(F.lit("AC0"), F.lit("AS_VQSR")))
        .alias("filters"),
        F.struct(
            per_allele(price / 110000.0, discount).alias("AF"),
            per_allele(tax, tax / 2).alias("AF_XX"),
            per_allele(discount, tax).alias("AF_XY"),
            F.col("l_suppkey").alias("AN"),
            (F.col("l_quantity") > 25).alias("lcr"),
        ).alias("INFO"),
    )


# Header of the VCF text written from ``nested_variants``.
VCF_HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=AF,Number=A,Type=Float,Description="Frequency, all samples">',
    '##INFO=<ID=AF_XX,Number=A,Type=Float,Description="Frequency in XX">',
    '##INFO=<ID=AF_XY,Number=A,Type=Float,Description="Frequency in XY">',
    '##INFO=<ID=AN,Number=1,Type=Integer,Description="Allele number">',
    '##INFO=<ID=lcr,Number=0,Type=Flag,Description="Low complexity">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
]


def vcf_lines(nested: DataFrame) -> DataFrame:
    """VCF text of ``nested_variants``, POS as stored in ``start``."""
    numbers = lambda name: F.coalesce(
        F.array_join(F.col(f"INFO.{name}").cast("array<string>"), ","), F.lit(".")
    )
    info = F.concat(
        *[F.concat(F.lit(f"{n}="), numbers(n), F.lit(";")) for n in ("AF", "AF_XX", "AF_XY")],
        F.lit("AN="),
        F.col("INFO.AN").cast("string"),
        F.when(F.col("INFO.lcr"), ";lcr").otherwise(""),
    )
    return nested.select(
        F.concat_ws(
            "\t",
            "contigName",
            F.col("start").cast("string"),
            F.lit("."),
            "referenceAllele",
            F.coalesce(F.array_join("alternateAlleles", ","), F.lit(".")),
            F.lit("."),
            F.array_join("filters", ";"),
            info,
        ).alias("value")
    )


# The extra field of a block-gzip member and the empty member a file ends with.
_MEMBER = bytes.fromhex("1f8b08040000000000ff060042430200")
_END = _MEMBER + bytes.fromhex("1b0003000000000000000000")


def block_gzip_parts(texts: Iterable[bytes], size: int = 0xFF00) -> Iterator[bytes]:
    """``texts``, one after the other, as the members of a block-gzip file, ``size`` bytes of text each.

    Holds one of the texts and one member at a time.
    """

    def member(part: bytes) -> bytes:
        tool = zlib.compressobj(6, zlib.DEFLATED, -15)
        packed = tool.compress(part) + tool.flush()
        length = len(_MEMBER) + 2 + len(packed) + 8
        sums = zlib.crc32(part).to_bytes(4, "little") + len(part).to_bytes(4, "little")
        return b"".join([_MEMBER, (length - 1).to_bytes(2, "little"), packed, sums])

    rest = b""
    for text in texts:
        data = rest + text
        whole = len(data) - len(data) % size
        for i in range(0, whole, size):
            yield member(data[i : i + size])
        rest = data[whole:]
    if rest:
        yield member(rest)
    yield _END


def block_gzip_bytes(data: bytes, size: int = 0xFF00) -> bytes:
    """``data`` as a block-gzip file with members of ``size`` bytes of text."""
    return b"".join(block_gzip_parts([data], size))


def write_block_gzip(lines: DataFrame, folder: str, header: list[str], size: int = 0xFF00) -> DataFrame:
    """One block-gzip file per task with the header and its ``value`` lines; returns ``path``.

    A task writes batch by batch and names its file when it is whole.
    """
    os.makedirs(folder, exist_ok=True)

    def text(values: list[str]) -> bytes:
        return "".join(f"{line}\n" for line in values).encode()

    def write(batches):
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():05d}.vcf.bgz"
        texts = chain([header], (batch.column("value").to_pylist() for batch in batches))
        with open(f"{path}.{task.taskAttemptId()}", "wb") as file:
            file.writelines(block_gzip_parts(map(text, texts), size))
        os.replace(file.name, path)
        yield pa.RecordBatch.from_pydict({"path": [path]})

    return lines.select("value").mapInArrow(write, "path string")


VCF_NUMBER_HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=AC,Number=A,Type=Integer,Description="Count per alternate">',
    '##INFO=<ID=AD,Number=R,Type=Integer,Description="Depth per allele">',
    '##INFO=<ID=GC,Number=G,Type=Integer,Description="Count per genotype">',
    '##INFO=<ID=HIST,Number=2,Type=Integer,Description="Histogram">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
]


def vcf_number_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VCF text with one or two alternates and a field per alternate, per allele and per genotype.

    Genotype values of a record are its line number times 10 plus their place.
    """
    n, base = F.col("l_linenumber"), F.col("l_linenumber") * 10
    two = n % 2 == 0
    listed = lambda count, start: F.array_join(
        F.transform(F.sequence(F.lit(0), count), lambda i: (start + i).cast("string")), ","
    )
    info = F.concat(
        F.lit("AC="), listed(F.when(two, 1).otherwise(0), F.col("l_suppkey")),
        F.lit(";AD="), listed(F.when(two, 2).otherwise(1), F.col("l_partkey")),
        F.lit(";GC="), listed(F.when(two, 5).otherwise(2), base),
        F.lit(";HIST="), listed(F.lit(1), n),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            "\t",
            F.lit("chr1"),
            F.col("l_orderkey").cast("string"),
            F.lit("."),
            "l_returnflag",
            F.when(two, F.lit("T,G")).otherwise("T"),
            F.lit("."),
            F.lit("PASS"),
            info,
        ).alias("value")
    )


def annotation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations under the column names of the source files, all strings.

    At most one row per key and label, so that a key repeats a few times and a
    join never pairs all lines of a hot key with each other.
    """
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    size = F.col("size")
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy(
            bare_chromosome_of(F.col("l_partkey")).alias("#chr"),
            F.col("l_orderkey").cast("string").alias("pos(1-based)"),
            F.col("l_returnflag").alias("ref"),
            F.col("l_linestatus").alias("alt"),
            F.col("p_type").alias("clinvar_clnsig"),
        )
        .agg(F.max("p_size").alias("size"), F.max("l_tax").alias("tax"))
        .select(
            *["#chr", "`pos(1-based)`", "ref", "alt"],
            F.when(size % 10 == 0, None)
            .when(size % 10 == 1, "")
            .otherwise(F.concat(F.lit("Brand#"), size.cast("string")))
            .alias("genename"),
            "clinvar_clnsig",
            F.col("tax").cast("string").alias("gnomAD_genomes_AF"),
        )
    )


def gene_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as gene records: dotted names, some NULL and some long texts."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("Gene_name"),
        F.col("source").alias("Gene.source"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("Pathway(KEGG)_full"),
        F.translate("text", "\t\n\r", "   ").alias("function.description"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as query runs; seconds are quarters, so sums are exact."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("engine"),
        F.when(F.col("event_type") == "signup", "load").otherwise("query").alias("kind"),
        F.col("ts").alias("start_time"),
        (F.floor(F.col("value") * 100) / 4).alias("seconds"),
        (F.floor(F.col("value") * 1000) * 1000000).alias("bytes_processed"),
    )


def usage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.expr("INTERVAL 60 SECONDS")).alias("end_time"),
        F.floor("value").alias("charged_seconds"),
    )
