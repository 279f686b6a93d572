"""Oracle SQL for DuckDB over the driver's tables."""

from __future__ import annotations

_CHROMOSOME = """CASE {key} % 24 WHEN 22 THEN 'X' WHEN 23 THEN 'Y'
 ELSE CAST({key} % 24 + 1 AS VARCHAR) END"""

_PRICE = "l_extendedprice / CAST(110000 AS DOUBLE)"
_LINE = "CAST(l_linenumber AS DOUBLE)"
_ASJ = f"CASE WHEN {_LINE} = 7 THEN NULL ELSE l_tax / 2 END"
_BIN = "FLOOR({x} / CAST(0.05 AS DOUBLE)) * CAST(0.05 AS DOUBLE)"

VARIANTS = f"""
variants AS (
 SELECT *, {_BIN.format(x="info_af")} AS info_af_range,
  info_af_xx - info_af_xy AS af_xx_minus_af_xy,
  ABS(info_af_xx - info_af_xy) AS af_xx_minus_af_xy_abs
 FROM (
  SELECT 'chr' || {_CHROMOSOME.format(key="l_partkey")} AS chromosome,
   l_orderkey AS start_position, l_returnflag AS refallele, l_linestatus AS altallele,
   {_PRICE} AS info_af, {_PRICE} + l_tax AS info_af_xx, {_PRICE} + l_discount AS info_af_xy,
   l_discount AS info_af_afr, l_tax AS info_af_amr, {_ASJ} AS info_af_asj,
   l_quantity / 100 AS info_af_eas, {_LINE} / 20 AS info_af_fin, l_discount * 2 AS info_af_nfe,
   l_discount + (l_quantity - 25) / 400 AS info_af_afr_xx, l_discount AS info_af_afr_xy,
   l_tax + ({_LINE} - 4) / 70 AS info_af_amr_xx, l_tax AS info_af_amr_xy,
   {_ASJ} + {_ASJ} AS info_af_asj_xx, {_ASJ} AS info_af_asj_xy,
   l_quantity / 100 + l_tax - l_discount AS info_af_eas_xx, l_quantity / 100 AS info_af_eas_xy,
   {_LINE} / 20 + ({_LINE} - 4) / 100 AS info_af_fin_xx, {_LINE} / 20 AS info_af_fin_xy,
   l_discount + l_discount / 3 AS info_af_mid_xx, l_discount AS info_af_mid_xy,
   l_discount * 2 + l_tax / 4 AS info_af_nfe_xx, l_discount * 2 AS info_af_nfe_xy,
   l_discount + (25 - l_quantity) / 600 AS info_af_sas_xx, l_discount AS info_af_sas_xy,
   CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 1 THEN '' ELSE p_brand END AS genename,
   CASE p_type WHEN 'ECONOMY' THEN 'Pathogenic' WHEN 'SMALL' THEN 'Likely_pathogenic'
    WHEN 'STANDARD' THEN 'Benign' WHEN 'PROMO' THEN 'Pathogenic|association'
    WHEN 'MEDIUM' THEN 'Uncertain_significance' END AS clinvar_clnsig,
   CASE o_orderpriority WHEN '1-URGENT' THEN 'reviewed_by_expert_panel'
    WHEN '2-HIGH' THEN 'criteria_provided' END AS clinvar_review,
   p_name AS clinvar_trait, l_returnflag || '>' || l_linestatus AS clinvar_hgvs
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
 )
)"""

GENES = """
genes AS (
 SELECT p_brand AS Gene_name, MIN(p_name) AS gene_full_name, MAX(p_type) AS function_description,
  MIN(p_type) AS disease_description, MAX(p_name) AS Pathway_KEGG__full
 FROM part GROUP BY p_brand
)"""

# One row per alternate allele of the nested variants.
FLAT = f"""
flat AS (
 SELECT 'chr' || {_CHROMOSOME.format(key="l_partkey")} AS contigName, l_orderkey AS start,
  l_returnflag AS referenceAllele,
  CASE allele WHEN 0 THEN l_linestatus ELSE 'T' END AS alternateAllele,
  CASE WHEN l_quantity > 10 THEN CASE allele WHEN 0 THEN 'PASS' END
   ELSE CASE allele WHEN 0 THEN 'AC0' ELSE 'AS_VQSR' END END AS filters,
  CASE allele WHEN 0 THEN {_PRICE} ELSE l_discount END AS INFO_AF,
  CASE allele WHEN 0 THEN l_tax ELSE l_tax / 2 END AS INFO_AF_XX,
  CASE allele WHEN 0 THEN l_discount ELSE l_tax END AS INFO_AF_XY,
  l_suppkey AS INFO_AN, l_quantity > 25 AS INFO_lcr
 FROM lineitem, (SELECT 0 AS allele UNION ALL SELECT 1) alleles
 WHERE allele < l_linenumber % 3
)"""

NOTES = f"""
notes AS (
 SELECT chromosome, start_position, refallele, altallele,
  CASE WHEN size % 10 = 0 THEN NULL WHEN size % 10 = 1 THEN '' ELSE 'Brand#' || size END
   AS genename, clinvar_clnsig, CAST(tax AS VARCHAR) AS gnomAD_genomes_AF
 FROM (
  SELECT 'chr' || {_CHROMOSOME.format(key="l_partkey")} AS chromosome,
   l_orderkey AS start_position, l_returnflag AS refallele, l_linestatus AS altallele,
   p_type AS clinvar_clnsig, MAX(p_size) AS size, MAX(l_tax) AS tax
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY ALL
 )
)"""

MERGED = f"""
merged AS (
 SELECT f.contigName AS chromosome, f.start AS start_position, f.referenceAllele AS refallele,
  f.alternateAllele AS altallele, f.INFO_AF, f.INFO_AF_XX,
  {_BIN.format(x="f.INFO_AF")} AS info_af_range,
  ABS(f.INFO_AF_XX - f.INFO_AF_XY) AS AF_XX_MINUS_AF_XY_ABS, n.genename, n.clinvar_clnsig
 FROM flat f LEFT JOIN notes n ON f.contigName = n.chromosome AND f.start = n.start_position
  AND f.referenceAllele = n.refallele AND f.alternateAllele = n.altallele
 WHERE f.filters = 'PASS'
)"""

_AUTOSOMES = "chromosome NOT IN ('chrX', 'chrY')"
_SMALL_ELSEWHERE = " AND ".join(
    f"ABS(info_af_{p}_xx - info_af_{p}_xy) < CAST(0.05 AS DOUBLE)"
    for p in ("afr", "amr", "asj", "fin", "mid", "nfe", "sas")
)
_SEX = f"{_AUTOSOMES} AND af_xx_minus_af_xy_abs >= CAST(0.05 AS DOUBLE)"
_SEX_UP = f"{_AUTOSOMES} AND af_xx_minus_af_xy >= CAST(0.05 AS DOUBLE)"
_SEX_DOWN = f"{_AUTOSOMES} AND af_xx_minus_af_xy <= CAST(-0.05 AS DOUBLE)"
_EAS_GAP = "info_af_eas_xx - info_af_eas_xy"
_EAS = f"{_AUTOSOMES} AND ABS({_EAS_GAP}) >= CAST(0.05 AS DOUBLE) AND {_SMALL_ELSEWHERE}"
_EAS_UP = f"{_AUTOSOMES} AND {_EAS_GAP} >= CAST(0.05 AS DOUBLE) AND {_SMALL_ELSEWHERE}"
_EAS_DOWN = f"{_AUTOSOMES} AND {_EAS_GAP} <= CAST(-0.05 AS DOUBLE) AND {_SMALL_ELSEWHERE}"
_REVIEWED = "clinvar_clnsig = 'Pathogenic' AND clinvar_review = 'reviewed_by_expert_panel'"


def _counts(key: str, where: str = "TRUE", k: int = 25) -> str:
    return f"""WITH {VARIANTS}
SELECT {key}, COUNT(*) AS count FROM variants WHERE {where}
GROUP BY {key} ORDER BY count DESC, {key} ASC NULLS LAST LIMIT {k}"""


def _overview(source: str, gap: str, dimensions: dict[str, int], conditions: dict[str, str]) -> str:
    """Single reports, each with its own condition and size, put side by side.

    ``conditions`` has the condition of "" (either way), "_up" and "_down".
    """
    union = " UNION ALL "
    base = union.join(
        f"""SELECT '{key}' AS dimension, CAST({key} AS VARCHAR) AS value, COUNT(*) AS count,
 COUNT(CASE WHEN {gap} >= CAST(0.05 AS DOUBLE) THEN 1 END) AS count_up,
 COUNT(CASE WHEN {gap} <= CAST(-0.05 AS DOUBLE) THEN 1 END) AS count_down
 FROM variants WHERE {conditions[""]} GROUP BY {key}"""
        for key in dimensions
    )
    singles = {
        end: union.join(
            f"""SELECT '{key}' AS dimension, value, CAST(ROW_NUMBER() OVER (ORDER BY count DESC,
 value ASC NULLS LAST) AS INTEGER) AS place FROM (SELECT CAST({key} AS VARCHAR) AS value, COUNT(*) AS count
 FROM variants WHERE {where} GROUP BY {key} ORDER BY count DESC, value ASC NULLS LAST LIMIT {k})"""
            for key, k in dimensions.items()
        )
        for end, where in conditions.items()
    }
    names = {"": "a", "_up": "b", "_down": "c"}
    joins = " ".join(
        f"LEFT JOIN ({singles[end]}) {n} ON base.dimension = {n}.dimension"
        f" AND base.value IS NOT DISTINCT FROM {n}.value"
        for end, n in names.items()
    )
    return f"""WITH {source}
SELECT base.*, a.place AS place, b.place AS place_up, c.place AS place_down FROM ({base}) base {joins}
WHERE a.place IS NOT NULL OR b.place IS NOT NULL OR c.place IS NOT NULL"""


_REPORT_SIZES = {"chromosome": 24, "genename": 25, "clinvar_clnsig": 25}


_PAIRS = " + ".join(
    f"COALESCE(ABS(info_af_{a} - info_af_{b}), 0)"
    for i, a in enumerate(("afr", "amr", "asj", "eas", "fin", "nfe"))
    for b in ("afr", "amr", "asj", "eas", "fin", "nfe")[i + 1 :]
)
_FREQUENCIES = ["info_af", "info_af_xx", "info_af_xy"]
_FREQUENCIES += [f"info_af_{p}" for p in ("afr", "amr", "asj", "eas", "fin", "nfe")]
_FREQUENCIES += [
    f"info_af_{p}_{s}"
    for p in ("afr", "amr", "asj", "eas", "fin", "mid", "nfe", "sas")
    for s in ("xx", "xy")
]
_FREQUENCIES += ["info_af_range", "af_xx_minus_af_xy", "af_xx_minus_af_xy_abs"]

_RUNS = """
runs AS (
 SELECT event_id AS run_id, event_type AS engine,
  CASE WHEN event_type = 'signup' THEN 'load' ELSE 'query' END AS kind,
  FLOOR(value * 100) / 4 AS seconds,
  CAST(FLOOR(value * 1000) AS BIGINT) * 1000000 AS bytes_processed
 FROM events
)"""


def _duration(seconds: str) -> str:
    return (
        f"printf('%.1fh%.1fm%.2fs', FLOOR(({seconds}) / 3600), "
        f"FLOOR((({seconds}) % 3600) / 60), ({seconds}) % 60)"
    )


SUITE = {
    "q01_af_range_share": f"""WITH {VARIANTS}
SELECT info_af_range, COUNT(*) AS count,
 ROUND(COUNT(*) / (SELECT COUNT(*) FROM variants) * 100, 3) AS info_af_range_percentage
FROM variants GROUP BY info_af_range ORDER BY info_af_range ASC NULLS FIRST LIMIT 25""",
    "q02_rare_rate_by_chromosome": f"""WITH {VARIANTS}
SELECT chromosome, COUNT(*) AS total_variant_count,
 CAST(SUM(CASE WHEN info_af <= CAST(0.01 AS DOUBLE) THEN 1 ELSE 0 END) AS BIGINT)
  AS rare_variant_count,
 ROUND(SUM(CASE WHEN info_af <= CAST(0.01 AS DOUBLE) THEN 1 ELSE 0 END) / COUNT(*) * 100, 2)
  AS rare_variant_pct
FROM variants GROUP BY chromosome ORDER BY chromosome ASC NULLS FIRST LIMIT 24""",
    "q03_clnsig_share": f"""WITH {VARIANTS}
SELECT clinvar_clnsig, COUNT(*) AS count,
 ROUND(COUNT(*) / (SELECT COUNT(*) FROM variants WHERE clinvar_clnsig IS NOT NULL) * 100, 3)
  AS clinvar_clnsig_percentage
FROM variants WHERE clinvar_clnsig IS NOT NULL GROUP BY clinvar_clnsig
ORDER BY clinvar_clnsig_percentage DESC, clinvar_clnsig ASC NULLS LAST LIMIT 100""",
    "q04_sex_diff_by_chromosome": _counts("chromosome", _SEX, 24),
    "q05_sex_diff_by_gene": _counts("genename", _SEX),
    "q06_sex_diff_by_clnsig": _counts("clinvar_clnsig", _SEX),
    "q07_sex_diff_xx_by_clnsig": _counts("clinvar_clnsig", _SEX_UP),
    "q08_sex_diff_xy_by_clnsig": _counts("clinvar_clnsig", _SEX_DOWN),
    "q09_eas_only_by_chromosome": _counts("chromosome", _EAS, 24),
    "q10_eas_only_by_gene": _counts("genename", _EAS),
    "q11_eas_only_by_clnsig": _counts("clinvar_clnsig", _EAS),
    "q12_eas_only_xx_by_clnsig": _counts("clinvar_clnsig", _EAS_UP),
    "q13_eas_only_xy_by_clnsig": _counts("clinvar_clnsig", _EAS_DOWN),
    "q14_pathogenic_by_gene": _counts(
        "genename",
        "clinvar_clnsig IN ('Pathogenic', 'Likely_pathogenic', 'Pathogenic/Likely_pathogenic', "
        "'Pathogenic|association', 'Pathogenic|drug_response')",
    ),
    "q15_reviewed_pathogenic_by_gene": _counts("genename", _REVIEWED),
    "q16_pathogenic_af_extent": f"""WITH {VARIANTS}
SELECT genename, MIN(info_af) AS known_pathogenic_af_min, MAX(info_af) AS known_pathogenic_af_max
FROM variants WHERE {_REVIEWED} GROUP BY genename
ORDER BY known_pathogenic_af_max DESC NULLS LAST, genename ASC NULLS LAST LIMIT 25""",
    "q17_divergent_variants": f"""WITH {VARIANTS}, {GENES},
ad AS (
 SELECT *, ROUND({_PAIRS}, 3) AS af_diff FROM variants
 WHERE genename IS NOT NULL AND genename <> ''
)
SELECT chromosome, start_position, refallele, altallele, af_diff, gene_full_name,
 function_description, disease_description, Pathway_KEGG__full,
 clinvar_clnsig, clinvar_trait, clinvar_review, clinvar_hgvs
FROM ad JOIN genes ON genename = Gene_name
ORDER BY af_diff DESC NULLS LAST, chromosome NULLS LAST, start_position NULLS LAST,
 refallele NULLS LAST, altallele NULLS LAST, clinvar_clnsig NULLS LAST,
 clinvar_trait NULLS LAST, clinvar_review NULLS LAST, clinvar_hgvs NULLS LAST,
 genename NULLS LAST, gene_full_name NULLS LAST, function_description NULLS LAST,
 disease_description NULLS LAST, Pathway_KEGG__full NULLS LAST
LIMIT 25""",
    "q18_clnsig_values": _counts("clinvar_clnsig"),
    "q19_review_values": _counts("clinvar_review"),
}

OPERATORS = {
    "sex_diff_overview": _overview(
        VARIANTS, "af_xx_minus_af_xy", _REPORT_SIZES, {"": _SEX, "_up": _SEX_UP, "_down": _SEX_DOWN}
    ),
    "eas_only_overview": _overview(
        VARIANTS, f"({_EAS_GAP})", _REPORT_SIZES, {"": _EAS, "_up": _EAS_UP, "_down": _EAS_DOWN}
    ),
    "overview_many_values": _overview(
        "variants AS (SELECT p_name, supplier_label, l_tax - l_discount AS gap FROM (SELECT l_partkey,"
        " l_tax, l_discount, CAST(l_suppkey AS VARCHAR) AS supplier_label FROM lineitem)"
        " JOIN part ON l_partkey = p_partkey)",
        "gap",
        {"p_name": 25, "supplier_label": 24},
        {
            "": "ABS(gap) >= CAST(0.05 AS DOUBLE)",
            "_up": "gap >= CAST(0.05 AS DOUBLE)",
            "_down": "gap <= CAST(-0.05 AS DOUBLE)",
        },
    ),
    "struct_flatten": """SELECT l_orderkey, l_linenumber, l_quantity AS price_qty,
 l_tax AS price_tax, l_returnflag AS state_flag FROM lineitem""",
    "allele_explode_align": """SELECT vec_id, embedding[idx] AS "alternateAllele",
 CASE WHEN idx <= 3 THEN embedding[idx] END AS head, label
FROM (SELECT *, generate_subscripts(embedding, 1) AS idx FROM embeddings)""",
    "allele_explode_keep": """SELECT p_partkey, words[idx] AS "alternateAllele",
 CASE idx WHEN 1 THEN p_retailprice WHEN 2 THEN CAST(p_size AS DOUBLE) END AS scores,
 p_brand || ';' || p_type AS filters
FROM (SELECT *, generate_subscripts(words, 1) AS idx
 FROM (SELECT *, string_split(p_name, ' ') AS words FROM part))""",
    "name_clean": """SELECT c_custkey AS "Gene_key", c_name AS "Pathway_KEGG__full",
 c_acctbal AS acct_bal FROM customer""",
    "key_rename_prefix": f"WITH {NOTES} SELECT * FROM notes",
    # Empty text in a TSV file is read as NULL.
    "tsv_ingest": f"""WITH {NOTES}
SELECT * REPLACE (NULLIF(genename, '') AS genename) FROM notes""",
    "project_by_name": f"""WITH {VARIANTS}, {NOTES}
SELECT refallele, {", ".join(f"MAX({c}) AS {c}" for c in _FREQUENCIES)},
 CAST(NULL AS VARCHAR) AS genename, CAST(NULL AS VARCHAR) AS clinvar_clnsig
FROM variants GROUP BY refallele
UNION ALL
SELECT NULL, {", ".join("NULL" for _ in _FREQUENCIES)}, genename, MAX(clinvar_clnsig)
FROM notes GROUP BY genename""",
    "bin_fixed_width": f"""SELECT l_orderkey, l_linenumber,
 {_BIN.format(x="l_discount")} AS discount_range, {_BIN.format(x=f"({_PRICE})")} AS price_range
FROM lineitem""",
    "signed_abs_diff": """SELECT l_orderkey, l_linenumber, l_tax - l_discount AS signed,
 ABS(l_tax - l_discount) AS magnitude,
 ROUND(ABS(l_tax - l_discount) + ABS(l_tax - l_quantity / 100)
  + ABS(l_discount - l_quantity / 100), 3) AS divergence
FROM lineitem""",
    "frequency_derivation": f"""WITH {FLAT}
SELECT contigName, start, referenceAllele, filters, alternateAllele, INFO_AF, INFO_AF_XX,
 INFO_AF_XY, INFO_AN, {_BIN.format(x="INFO_AF")} AS info_af_range,
 INFO_AF_XX - INFO_AF_XY AS AF_XX_MINUS_AF_XY,
 ABS(INFO_AF_XX - INFO_AF_XY) AS AF_XX_MINUS_AF_XY_ABS
FROM flat""",
    "max_length_filter": """SELECT doc_id, lang, source, n_chars FROM documents
WHERE lang <> 'de' AND LENGTH(lang) <= 2000 AND LENGTH(text) <= 2000 AND LENGTH(source) <= 2000""",
    "max_length_filter_nulls": """SELECT doc_id, CASE WHEN lang <> 'de' THEN lang END AS lang,
 source, n_chars FROM documents
WHERE LENGTH(text) <= 65535 OR text IS NULL""",
    "union_shards": """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
    "annotate_left_join": f"WITH {FLAT}, {NOTES}, {MERGED} SELECT * FROM merged",
    "annotate_hot_keys": """SELECT customers.key, l_orderkey, l_returnflag
FROM (SELECT DISTINCT c_custkey AS key FROM customer) customers LEFT JOIN (
 SELECT CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_suppkey * 16 END AS key,
  l_orderkey, l_returnflag FROM lineitem) notes ON customers.key = notes.key""",
    "string_key_join": """SELECT l_orderkey AS start_position, l_linenumber, o_orderstatus
FROM lineitem LEFT JOIN (
 SELECT DISTINCT TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN o_orderkey || 'x'
  ELSE CAST(o_orderkey AS VARCHAR) END AS BIGINT) AS pos, o_orderstatus FROM orders)
 ON l_orderkey = pos""",
    "gene_inner_join": f"""WITH {VARIANTS}, {GENES}
SELECT chromosome, start_position, refallele, altallele, genename, genes.*
FROM variants JOIN genes ON genename = Gene_name""",
    "variant_count": f"WITH {VARIANTS} SELECT COUNT(*) AS cnt FROM variants",
    "known_significance_count": f"""WITH {VARIANTS}
SELECT COUNT(*) AS cnt FROM variants WHERE clinvar_clnsig IS NOT NULL""",
    "preview": """SELECT doc_id, lang, n_chars FROM documents
ORDER BY lang NULLS FIRST, doc_id NULLS FIRST LIMIT 10""",
    "sql_view": f"""WITH {VARIANTS}
SELECT chromosome, COUNT(*) AS count, MAX(info_af) AS info_af_max FROM variants
WHERE info_af < CAST(0.5 AS DOUBLE) AND clinvar_review IS NOT NULL AND refallele <> 'N'
GROUP BY chromosome""",
    "vcf_ingest": f"""WITH {FLAT}
SELECT contigName, start, start + LENGTH(referenceAllele) - 1 AS "end", referenceAllele,
 filters, alternateAllele, INFO_AF, INFO_AF_XX, INFO_AF_XY, INFO_AN, INFO_lcr FROM flat""",
    "vcf_zero_based": f"""SELECT 'chr' || {_CHROMOSOME.format(key="l_partkey")} AS "contigName",
 l_orderkey - 1 AS start, l_orderkey AS "end", l_returnflag AS "referenceAllele",
 l_suppkey AS "INFO_AN", l_quantity > 25 AS "INFO_lcr" FROM lineitem""",
    "vcf_by_number": """SELECT l_orderkey AS start, CASE k WHEN 1 THEN 'T' ELSE 'G' END AS "alternateAllele",
 l_suppkey + k - 1 AS "INFO_AC", concat(l_partkey, ',', l_partkey + k) AS "INFO_AD",
 concat(l_linenumber * 10, ',', l_linenumber * 10 + CASE k WHEN 1 THEN 1 ELSE 3 END, ',',
  l_linenumber * 10 + CASE k WHEN 1 THEN 2 ELSE 5 END) AS "INFO_GC",
 concat(l_linenumber, ',', l_linenumber + 1) AS "INFO_HIST"
FROM lineitem, (VALUES (1), (2)) AS alternates(k) WHERE k = 1 OR l_linenumber % 2 = 0""",
    "gene_ingest": """SELECT CAST(doc_id AS VARCHAR) AS "Gene_name", source AS "Gene_source",
 lang AS "Pathway_KEGG__full", translate(text, chr(9) || chr(10) || chr(13), '   ')
  AS function_description
FROM documents WHERE lang <> 'de' AND LENGTH(text) <= 65535""",
    "shard_scan": f"""WITH {VARIANTS}
SELECT chromosome, start_position, refallele, altallele, info_af FROM variants""",
    "external_table": f"WITH {GENES} SELECT * FROM genes",
    "clustered_write": f"""WITH {VARIANTS}
SELECT chromosome, start_position, refallele, altallele, info_af, info_af_asj, genename,
 clinvar_clnsig, clinvar_review FROM variants""",
    "merged_build": f"""WITH {FLAT}, {NOTES}, {MERGED}
SELECT chromosome, COUNT(*) AS total_variant_count,
 COUNT(CASE WHEN INFO_AF <= CAST(0.3 AS DOUBLE) THEN 1 END) AS rare_variant_count,
 ROUND(COUNT(CASE WHEN INFO_AF <= CAST(0.3 AS DOUBLE) THEN 1 END) / COUNT(*) * 100, 2)
  AS rare_variant_pct
FROM merged GROUP BY chromosome""",
    "load_checked": "SELECT * FROM orders",
    "string_width_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(MAX(LENGTH({c})) AS INTEGER) AS max_length,
 CAST(COALESCE(LEAST(MAX(LENGTH({c})) + 5, 65535), 65535) AS INTEGER) AS width FROM documents"""
        for c in ("text", "lang", "source")
    ),
    "typed_table": "SELECT * FROM customer",
    "table_stats": f"""WITH {NOTES}
{" UNION ALL ".join(
    f'''SELECT '{name}' AS column_name, COUNT(*) - COUNT({column}) AS num_nulls,
 CAST(MAX(LENGTH({column})) AS BIGINT) AS max_col_len FROM notes'''
    for name, column in (
        ("#chr", "substr(chromosome, 4)"),
        ("pos(1-based)", "CAST(start_position AS VARCHAR)"),
        ("ref", "refallele"),
        ("genename", "genename"),
        ("clinvar_clnsig", "clinvar_clnsig"),
        ("gnomAD_genomes_AF", "gnomAD_genomes_AF"),
    )
)}""",
    "scan_cost_report": f"""WITH {_RUNS}
SELECT *, bytes_processed / CAST(1e9 AS DOUBLE) AS gb_processed,
 bytes_processed / CAST(1e12 AS DOUBLE) * CAST(5.0 AS DOUBLE) AS cost,
 {_duration("seconds")} AS runtime
FROM runs""",
    "scan_cost_totals": f"""WITH {_RUNS}
SELECT SUM(seconds) AS total_seconds, {_duration("SUM(seconds)")} AS total_runtime,
 CAST(SUM(bytes_processed) AS DOUBLE) / CAST(1e9 AS DOUBLE) AS total_gb,
 CAST(SUM(bytes_processed) AS DOUBLE) / CAST(1e12 AS DOUBLE) * CAST(6.25 AS DOUBLE) AS total_cost
FROM runs""",
    "charged_cost_window": """SELECT
 COALESCE(CAST(SUM(CAST(FLOOR(value) AS BIGINT)) AS DOUBLE) / CAST(3600 AS DOUBLE)
  * CAST(0.375 AS DOUBLE), 0) AS cost_incurred
FROM events WHERE ts >= TIMESTAMP '2024-01-05 10:20:00'
 AND ts + INTERVAL 60 SECONDS <= TIMESTAMP '2024-01-12 08:16:00'""",
    "runtime_totals": f"""WITH {_RUNS}
SELECT SUM(CASE WHEN kind = 'query' THEN seconds END) AS total_query_seconds,
 {_duration("SUM(CASE WHEN kind = 'query' THEN seconds END)")} AS total_query_runtime,
 SUM(FLOOR(seconds) / 4) AS total_cost
FROM runs""",
    "duration_text": f"""WITH {_RUNS}
SELECT run_id, {_duration("seconds * 40")} AS runtime FROM runs""",
}


_STORED = "SELECT CAST(SUM(strlen(COALESCE(o_orderpriority, '')) + 1) AS BIGINT) AS total_bytes FROM orders"
OPERATORS["stored_size"] = _STORED
OPERATORS["storage_cost"] = f"""SELECT total_bytes, total_bytes / CAST(1073741824 AS DOUBLE) AS total_gb,
 total_bytes / CAST(1073741824 AS DOUBLE) * CAST(0.024 AS DOUBLE) AS monthly_cost FROM ({_STORED})"""


OPERATORS["bucketed_merge"] = OPERATORS["annotate_left_join"]
OPERATORS["replace_shard"] = f"""WITH {VARIANTS}
SELECT chromosome, start_position, refallele, altallele,
 CASE WHEN chromosome = 'chr5' THEN -info_af ELSE info_af END AS info_af FROM variants"""
OPERATORS["shard_statistics"] = "WITH o AS (SELECT *, NULLIF(o_orderpriority, '5-LOW') AS o_comment FROM orders)" + (
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls,
 {f'CAST(MAX(LENGTH({c})) AS BIGINT)' if text else 'CAST(NULL AS BIGINT)'} AS max_length,
 CAST(MIN({c}) AS VARCHAR) AS min, CAST(MAX({c}) AS VARCHAR) AS max FROM o"""
        for c, text in (
            ("o_orderkey", False),
            ("o_custkey", False),
            ("o_orderstatus", True),
            ("o_totalprice", False),
            ("o_orderdate", False),
            ("o_orderpriority", True),
            ("o_comment", True),
        )
    )
)
OPERATORS["codec_rows"] = """SELECT c_custkey, c_name, c_acctbal, codec FROM customer,
 (VALUES ('none'), ('snappy'), ('gzip'), ('zstd'), ('lz4')) AS codecs(codec)"""
OPERATORS["sql_text_share"] = SUITE["q01_af_range_share"]
OPERATORS["sql_text_divergence"] = SUITE["q17_divergent_variants"]
OPERATORS["run_log_rows"] = f"""WITH {VARIANTS}
SELECT name, 'query' AS kind, (SELECT COUNT(*) FROM variants) AS rows_read, rows_out FROM (
 SELECT 'q01_af_range_share' AS name, COUNT(*) AS rows_out FROM ({SUITE["q01_af_range_share"]})
 UNION ALL SELECT 'q02_rare_rate_by_chromosome', COUNT(*) FROM ({SUITE["q02_rare_rate_by_chromosome"]})
 UNION ALL SELECT 'q18_clnsig_values', COUNT(*) FROM ({SUITE["q18_clnsig_values"]}))"""
OPERATORS["vcf_block_gzip"] = OPERATORS["vcf_ingest"]


def all_sql() -> dict[str, str]:
    return {**SUITE, **OPERATORS}
