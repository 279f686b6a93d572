"""The report suite over the merged variant table (and the gene table)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from alleleframe.functions.columns import quoted
from alleleframe.operators.analytics import (
    conditional_rate,
    difference_reports,
    report_of,
    extent_by_key,
    pairwise_divergence_topk,
    share_of_total,
    value_counts,
)
from alleleframe.operators.filters import autosomal, differs, differs_only_in
from alleleframe.operators.reshape import MERGE_KEYS

# Populations, labels and thresholds of the questions asked.
SEX_POPULATIONS = ["afr", "amr", "asj", "eas", "fin", "mid", "nfe", "sas"]
DIVERGENCE_POPULATIONS = ["afr", "amr", "asj", "eas", "fin", "nfe"]
PATHOGENIC_LABELS = [
    "Pathogenic",
    "Likely_pathogenic",
    "Pathogenic/Likely_pathogenic",
    "Pathogenic|association",
    "Pathogenic|drug_response",
]
EXPERT_REVIEW = "reviewed_by_expert_panel"
RARE_FREQUENCY = 0.01
LARGE_DIFFERENCE = 0.05
GENE_TEXTS = [
    "gene_full_name",
    "function_description",
    "disease_description",
    "Pathway(KEGG)_full",
]
CLINICAL_COLUMNS = ["clinvar_clnsig", "clinvar_trait", "clinvar_review", "clinvar_hgvs"]
DIMENSIONS = ["chromosome", "genename", "clinvar_clnsig"]
# Values per report: one per autosome and sex chromosome, else 25.
DIMENSION_SIZES = {d: 24 if d == "chromosome" else 25 for d in DIMENSIONS}


def _sex_pairs() -> dict[str, tuple[Column, Column]]:
    return {
        p: (F.col(f"info_af_{p}_xx"), F.col(f"info_af_{p}_xy")) for p in SEX_POPULATIONS
    }


def _sex_difference(direction: str | None = None) -> Column:
    return autosomal() & differs(
        F.col("AF_XX_MINUS_AF_XY"),
        LARGE_DIFFERENCE,
        direction,
        magnitude=F.col("AF_XX_MINUS_AF_XY_ABS"),
    )


def _east_asian_difference(direction: str | None = None) -> Column:
    return autosomal() & differs_only_in(_sex_pairs(), "eas", LARGE_DIFFERENCE, direction)


def _known_pathogenic() -> Column:
    return (F.col("clinvar_clnsig") == "Pathogenic") & (F.col("clinvar_review") == EXPERT_REVIEW)


def frequency_range_share(variants: DataFrame) -> DataFrame:
    return share_of_total(variants, "info_af_range", k=25)


def rare_rate_by_chromosome(variants: DataFrame) -> DataFrame:
    names = ["total_variant_count", "rare_variant_count", "rare_variant_pct"]
    rare = F.col("info_af") <= RARE_FREQUENCY
    return conditional_rate(variants, "chromosome", rare, names, k=24)


def significance_share(variants: DataFrame) -> DataFrame:
    known = F.col("clinvar_clnsig").isNotNull()
    return share_of_total(variants, "clinvar_clnsig", where=known, k=100, by_share=True)


def sex_difference_counts(
    variants: DataFrame, by: str, direction: str | None = None, k: int = 25
) -> DataFrame:
    return value_counts(variants, by, _sex_difference(direction), k)


def east_asian_difference_counts(
    variants: DataFrame, by: str, direction: str | None = None, k: int = 25
) -> DataFrame:
    return value_counts(variants, by, _east_asian_difference(direction), k)


def sex_difference_overview(variants: DataFrame) -> DataFrame:
    """The sex-difference reports of all dimensions and directions in one scan."""
    signed = F.col("AF_XX_MINUS_AF_XY")
    return difference_reports(variants, DIMENSION_SIZES, signed, LARGE_DIFFERENCE, _sex_difference())


def east_asian_difference_overview(variants: DataFrame) -> DataFrame:
    """The East-Asian-only reports of all dimensions and directions in one scan."""
    xx, xy = _sex_pairs()["eas"]
    return difference_reports(
        variants, DIMENSION_SIZES, xx - xy, LARGE_DIFFERENCE, _east_asian_difference()
    )


def pathogenic_by_gene(variants: DataFrame) -> DataFrame:
    return value_counts(variants, "genename", F.col("clinvar_clnsig").isin(PATHOGENIC_LABELS))


def reviewed_pathogenic_by_gene(variants: DataFrame) -> DataFrame:
    return value_counts(variants, "genename", _known_pathogenic())


def pathogenic_frequency_extent(variants: DataFrame) -> DataFrame:
    names = ["known_pathogenic_af_min", "known_pathogenic_af_max"]
    return extent_by_key(variants, "genename", "info_af", names, _known_pathogenic())


# Reports that an overview contains: dimension and direction.
_IN_OVERVIEW = {
    "by_chromosome": ("chromosome", None),
    "by_gene": ("genename", None),
    "by_clnsig": ("clinvar_clnsig", None),
    "xx_by_clnsig": ("clinvar_clnsig", "up"),
    "xy_by_clnsig": ("clinvar_clnsig", "down"),
}


def difference_suite(
    variants: DataFrame, collect: Callable[[DataFrame, str], list[Row]] = lambda df, name: df.collect()
) -> dict[str, DataFrame]:
    """The ten difference reports of the suite from two scans.

    An overview has at most three reports' rows per dimension, so it goes through
    the driver once and the reports are cut out of it. ``collect`` brings an
    overview, given with its name, to the driver.
    """
    found = {}
    for family, overview in (
        ("sex_diff", sex_difference_overview(variants)),
        ("eas_only", east_asian_difference_overview(variants)),
    ):
        few = overview.sparkSession.createDataFrame(collect(overview, family), overview.schema)
        for name in REPORTS:
            for ending, (dimension, direction) in _IN_OVERVIEW.items():
                if name[4:] == f"{family}_{ending}":
                    found[name] = report_of(few, dimension, direction)
    return found


def _in_any_case(genes: DataFrame, name: str) -> str:
    """Name of a gene column as this table spells it, odd characters or not."""
    plain = lambda text: "".join(ch for ch in text.lower() if ch.isalnum())
    found = [c for c in genes.columns if plain(c) == plain(name)]
    if not found:
        raise ValueError(f"the gene table has no column like {name}")
    return found[0]


def divergent_variants(variants: DataFrame, genes: DataFrame) -> DataFrame:
    top = pairwise_divergence_topk(
        variants,
        [f"info_af_{p}" for p in DIVERGENCE_POPULATIONS],
        genes,
        MERGE_KEYS + CLINICAL_COLUMNS,
        {_in_any_case(genes, c): c for c in GENE_TEXTS},
        gene_key=_in_any_case(genes, "Gene_name"),
    )
    return top.select(*MERGE_KEYS, "af_diff", *map(quoted, GENE_TEXTS), *CLINICAL_COLUMNS)


def significance_values(variants: DataFrame) -> DataFrame:
    return value_counts(variants, "clinvar_clnsig")


def review_values(variants: DataFrame) -> DataFrame:
    return value_counts(variants, "clinvar_review")


# Every report takes the merged variants and the genes; only GENE_REPORTS use genes.
GENE_REPORTS = {"q17_divergent_variants"}
REPORTS: dict[str, Callable[[DataFrame, DataFrame | None], DataFrame]] = {
    "q01_af_range_share": lambda v, g: frequency_range_share(v),
    "q02_rare_rate_by_chromosome": lambda v, g: rare_rate_by_chromosome(v),
    "q03_clnsig_share": lambda v, g: significance_share(v),
    "q04_sex_diff_by_chromosome": lambda v, g: sex_difference_counts(v, "chromosome", k=24),
    "q05_sex_diff_by_gene": lambda v, g: sex_difference_counts(v, "genename"),
    "q06_sex_diff_by_clnsig": lambda v, g: sex_difference_counts(v, "clinvar_clnsig"),
    "q07_sex_diff_xx_by_clnsig": lambda v, g: sex_difference_counts(v, "clinvar_clnsig", "up"),
    "q08_sex_diff_xy_by_clnsig": lambda v, g: sex_difference_counts(v, "clinvar_clnsig", "down"),
    "q09_eas_only_by_chromosome": lambda v, g: east_asian_difference_counts(
        v, "chromosome", k=24
    ),
    "q10_eas_only_by_gene": lambda v, g: east_asian_difference_counts(v, "genename"),
    "q11_eas_only_by_clnsig": lambda v, g: east_asian_difference_counts(v, "clinvar_clnsig"),
    "q12_eas_only_xx_by_clnsig": lambda v, g: east_asian_difference_counts(
        v, "clinvar_clnsig", "up"
    ),
    "q13_eas_only_xy_by_clnsig": lambda v, g: east_asian_difference_counts(
        v, "clinvar_clnsig", "down"
    ),
    "q14_pathogenic_by_gene": lambda v, g: pathogenic_by_gene(v),
    "q15_reviewed_pathogenic_by_gene": lambda v, g: reviewed_pathogenic_by_gene(v),
    "q16_pathogenic_af_extent": lambda v, g: pathogenic_frequency_extent(v),
    "q17_divergent_variants": divergent_variants,
    "q18_clnsig_values": lambda v, g: significance_values(v),
    "q19_review_values": lambda v, g: review_values(v),
}
