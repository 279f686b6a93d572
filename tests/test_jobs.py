"""The command line from text files to printed reports."""

from __future__ import annotations

import pytest
from test_sources import write_vcf

from alleleframe import jobs

POPULATIONS = ["afr", "amr", "asj", "eas", "fin", "mid", "nfe", "sas"]
FREQUENCIES = ["AF", "AF_XX", "AF_XY"]
FREQUENCIES += [f"AF_{p}{s}" for p in POPULATIONS for s in ("", "_XX", "_XY")]
HEADER = [f'##INFO=<ID={f},Number=A,Type=Float,Description="f">' for f in FREQUENCIES]
HEADER.append("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")


def info(**values):
    return ";".join(f"{f}={values.get(f, 0.01)}" for f in FREQUENCIES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    (base / "vcf").mkdir()
    write_vcf(
        base / "vcf" / "chr1.vcf.gz",
        [
            "chr1\t100\t.\tA\tT\t.\tPASS\t" + info(AF=0.2, AF_XX=0.3, AF_XY=0.1, AF_eas=0.9),
            "chr1\t200\t.\tA\tT\t.\tAC0\t" + info(),
        ],
        HEADER,
        compress=True,
    )
    write_vcf(
        base / "vcf" / "chr2.vcf.gz",
        ["chr2\t300\t.\tG\tC\t.\tPASS\t" + info(AF_eas_XX=0.3, AF_eas_XY=0.1)],
        HEADER,
        compress=True,
    )
    names = ["#chr", "pos(1-based)", "ref", "alt", "genename", "clinvar_clnsig", "clinvar_trait"]
    head = "\t".join([*names, "clinvar_review", "clinvar_hgvs", "gnomAD_AF"])
    (base / "ann.tsv").write_text(
        f"{head}\n1\t100\tA\tT\tBRCA2\tPathogenic\tt1\treviewed_by_expert_panel\th1\t.\n"
        "2\t300\tG\tC\tUSH2A\tBenign\tt2\tx\th2\t.\n"
    )
    (base / "genes.tsv").write_text(
        "Gene_name\tgene_full_name\tfunction_description\tdisease_description\tPathway(KEGG)_full\n"
        "BRCA2\tfull\tfunction\tdisease\tpathway\n"
    )
    return base


def test_from_text_to_reports(spark, folder, capsys):
    at = lambda name: str(folder / name)
    jobs.main(["variants", "--input", at("vcf"), "--output", at("variants.parquet")])
    jobs.main(
        ["annotations", "--input", at("ann.tsv"), "--output", at("ann.parquet"), "--table", "job_ann"]
    )
    jobs.main(["genes", "--input", at("genes.tsv"), "--output", at("genes.parquet")])
    jobs.main(
        ["merge", "--variants", at("variants.parquet"), "--annotations", "job_ann"]
        + ["--output", at("merged.parquet"), "--table", "job_merged"]
        + ["--partition-by", "chromosome", "--target-mb", "64"]
    )
    merged = spark.table("job_merged")
    assert "gnomAD_AF" not in merged.columns
    found = sorted(
        tuple(r) for r in merged.select("chromosome", "start_position", "INFO_AF", "genename").collect()
    )
    assert found == [("chr1", 100, 0.2, "BRCA2"), ("chr2", 300, 0.01, "USH2A")]
    capsys.readouterr()
    jobs.main(
        ["reports", "--merged", "job_merged", "--genes", at("genes.parquet"), "--run-log", at("runs")]
    )
    log = {r.name: r for r in spark.read.parquet(at("runs")).collect()}
    assert log["q01_af_range_share"].rows_read == 2 and log["q01_af_range_share"].bytes_processed > 0
    assert log["sex_diff"].files > 0 and log["q04_sex_diff_by_chromosome"].files == 0
    printed = capsys.readouterr().out
    assert printed.count("q1") >= 10 and "total_query_runtime" in printed
    assert "|chr1      |100           |A        |T        |" in printed
    jobs.main(["storage", "--path", at("merged.parquet")])
    assert "monthly_cost" in capsys.readouterr().out


def test_one_table_per_chromosome(spark, tmp_path):
    from alleleframe.sinks.storage import save_external_table
    from alleleframe.sources.tables import CHROMOSOMES

    for chromosome in CHROMOSOMES:
        df = spark.createDataFrame([(chromosome,)], "c string")
        save_external_table(df, f"shard_chr{chromosome}", str(tmp_path / f"chr{chromosome}"))
    both = [jobs.open_source(spark, "shard_chr{}"), jobs.open_source(spark, f"{tmp_path}/chr{{}}")]
    for df in both:
        assert sorted(r.c for r in df.collect()) == sorted(CHROMOSOMES)


def test_replacing_one_chromosome(spark, tmp_path):
    base = str(tmp_path / "by_chromosome")
    df = spark.range(30).selectExpr("concat('chr', id % 3) AS chromosome", "id AS start_position", "'a' AS v")
    df.write.partitionBy("chromosome").parquet(base)
    fresh = str(tmp_path / "fresh")
    spark.sql("SELECT 'chr1' AS chromosome, 7L AS start_position, 'b' AS v").write.parquet(fresh)
    jobs.main(["replace", "--source", fresh, "--output", base, "--shards", "chr1"])
    found = spark.read.parquet(base)
    assert found.count() == 21
    assert [r.v for r in found.where("chromosome = 'chr1'").collect()] == ["b"]
