"""Reports as SQL text with the tables as named arguments.

A text names its tables ``IDENTIFIER(:variants)`` and its values ``:k``; Spark
puts both in when it parses, so a text runs on any table, view or Parquet folder
and no name or value is pasted into it.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import combinations
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from alleleframe.plans.reports import DIVERGENCE_POPULATIONS

_DIVERGENCE = " + ".join(
    f"COALESCE(ABS(info_af_{a} - info_af_{b}), 0.0D)" for a, b in combinations(DIVERGENCE_POPULATIONS, 2)
)

TEXTS = {
    "q01_af_range_share": """
SELECT info_af_range, COUNT(*) AS count,
  ROUND(COUNT(*) / (SELECT COUNT(*) FROM IDENTIFIER(:variants)) * 100, 3) AS info_af_range_percentage
FROM IDENTIFIER(:variants)
GROUP BY info_af_range
ORDER BY info_af_range ASC NULLS FIRST""",
    "q02_rare_rate_by_chromosome": """
SELECT chromosome, COUNT(*) AS total_variant_count,
  COUNT(CASE WHEN info_af <= :rare THEN 1 END) AS rare_variant_count,
  ROUND(COUNT(CASE WHEN info_af <= :rare THEN 1 END) / COUNT(*) * 100, 2) AS rare_variant_pct
FROM IDENTIFIER(:variants)
GROUP BY chromosome
ORDER BY chromosome ASC NULLS FIRST
LIMIT :k""",
    # The gene texts meet only the last rows, as in operators.analytics.pairwise_divergence_topk.
    "q17_divergent_variants": f"""
WITH known AS (SELECT DISTINCT Gene_name AS genename FROM IDENTIFIER(:genes)),
top AS (
  SELECT chromosome, start_position, refallele, altallele, ROUND({_DIVERGENCE}, 3) AS af_diff,
    clinvar_clnsig, clinvar_trait, clinvar_review, clinvar_hgvs, genename
  FROM IDENTIFIER(:variants) LEFT SEMI JOIN known USING (genename)
  WHERE genename IS NOT NULL AND genename <> ''
  ORDER BY af_diff DESC NULLS LAST, chromosome NULLS LAST, start_position NULLS LAST,
    refallele NULLS LAST, altallele NULLS LAST, clinvar_clnsig NULLS LAST,
    clinvar_trait NULLS LAST, clinvar_review NULLS LAST, clinvar_hgvs NULLS LAST, genename NULLS LAST
  LIMIT :k
)
SELECT chromosome, start_position, refallele, altallele, af_diff, gene_full_name,
  function_description, disease_description, Pathway_KEGG__full,
  clinvar_clnsig, clinvar_trait, clinvar_review, clinvar_hgvs
FROM top JOIN IDENTIFIER(:genes) AS texts ON top.genename = texts.Gene_name
ORDER BY af_diff DESC NULLS LAST, chromosome NULLS LAST, start_position NULLS LAST,
  refallele NULLS LAST, altallele NULLS LAST, clinvar_clnsig NULLS LAST, clinvar_trait NULLS LAST,
  clinvar_review NULLS LAST, clinvar_hgvs NULLS LAST, top.genename NULLS LAST,
  gene_full_name NULLS LAST, function_description NULLS LAST, disease_description NULLS LAST,
  Pathway_KEGG__full NULLS LAST
LIMIT :k""",
}


def run_text(
    spark: SparkSession, text: str, tables: Mapping[str, str], values: Mapping[str, Any] | None = None
) -> DataFrame:
    """One SQL text, or one of ``TEXTS`` by name, on the given tables and values."""
    return spark.sql(TEXTS.get(text, text), args={**tables, **(values or {})})
