"""Reshaping, filters, joins and reports on literal rows."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from alleleframe.functions.columns import duration_text, fixed_width_bin, pairwise_divergence
from alleleframe.operators import analytics, annotate
from alleleframe.operators.annotate import (
    hot_keys,
    left_join_on_keys,
    merge_annotations,
)
from alleleframe.operators.filters import differs_only_in, within_length
from alleleframe.operators.reshape import (
    annotation_columns,
    clean_names,
    explode_alternates,
    flatten_structs,
    frequency_columns,
    numeric_position,
)
from alleleframe.plans import reports
from checks import derived


def test_flatten_is_one_level_and_one_projection(spark):
    df = spark.sql(
        "SELECT named_struct('a', 1, 'b', named_struct('c', 2)) AS s, 3 AS x, named_struct('d', 4) AS t"
    )
    flat = flatten_structs(df)
    assert flat.columns == ["x", "s_a", "s_b", "t_d"]
    assert flat.first().s_b.c == 2
    plan = flatten_structs(spark.range(1).select(F.struct("id").alias("s")))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Project") == 1


def test_explode_aligns_all_arrays(spark):
    df = spark.sql(
        "SELECT 1 AS id, array('A', 'T') AS alternateAlleles, array('PASS') AS filters, array(0.1D, 0.2D) AS af"
        " UNION ALL SELECT 2, array(), array('PASS'), array(0.3D)"
        " UNION ALL SELECT 3, NULL, array('PASS'), array(0.4D)"
    )
    assert rows(explode_alternates(df), "id", "alternateAllele", "filters", "af") == [
        (1, "A", "PASS", 0.1),
        (1, "T", None, 0.2),
    ]
    kept = explode_alternates(df, align=["af"])
    assert rows(kept, "alternateAllele", "filters", "af") == [("A", ["PASS"], 0.1), ("T", ["PASS"], 0.2)]


def test_bin_edges(spark):
    values = [(0.15,), (0.3,), (0.35,), (0.6,), (0.7,), (0.95,), (None,)]
    bins = spark.createDataFrame(values, "x double").select(fixed_width_bin(F.col("x")).alias("b"))
    expected = [n * 0.05 for n in (2, 5, 6, 11, 13, 18)]
    assert [r.b for r in bins.collect()] == [*expected, None]


def test_length_filter_drops_nulls(spark):
    df = spark.createDataFrame([("a", "b", 1), ("a", None, 2), ("abc", "b", 3)], "x string, y string, n int")
    assert rows(within_length(df, 2), "n") == [(1,)]
    assert rows(within_length(df, 2, keep_nulls=True), "n") == [(1,), (2,)]
    assert within_length(df.select("n"), 2).count() == 3


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a.b", "Pathway(KEGG)_full", "#chr"])
    assert clean_names(df).columns == ["a_b", "Pathway(KEGG)_full", "#chr"]
    assert clean_names(df, strict=True).columns == ["a_b", "Pathway_KEGG__full", "_chr"]


def test_projection_by_name():
    columns = ["INFO_AF", "info_af_eas", "AF_XX_MINUS_AF_XY", "af", "INFO_AN", "xaf_", "chromosome"]
    assert frequency_columns(columns) == ["INFO_AF", "info_af_eas", "AF_XX_MINUS_AF_XY"]
    columns = ["chromosome", "altallele", "gnomAD_AF", "gnomad_AF", "genename"]
    assert annotation_columns(columns) == ["gnomad_AF", "genename"]


def test_text_positions_join_without_error(spark):
    left = spark.createDataFrame([(5,), (7,)], "start_position bigint")
    right = spark.createDataFrame([("5", "a"), ("x", "b")], "start_position string, note string")
    with pytest.raises(TypeError, match="start_position"):
        left_join_on_keys(left, right, ["start_position"])
    joined = left_join_on_keys(left, numeric_position(right), ["start_position"])
    assert rows(joined) == [(5, "a"), (7, None)]


def skewed_tables(spark):
    """A third of each side holds one key; some keys are NULL or unmatched."""
    left = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") % 1000 == 0, None)
        .when(F.col("id") < 30, 7)
        .otherwise(F.col("id") % 400)
        .alias("k"),
        F.col("id").alias("l"),
    )
    right = spark.range(0, 900, 1, 4).select(
        F.when(F.col("id") % 100 == 0, None)
        .when(F.col("id") < 300, 7)
        .otherwise(F.col("id") % 350)
        .alias("k"),
        F.col("id").alias("r"),
    )
    return left, right


def hashes(spark, *keys, names):
    return spark.createDataFrame(list(keys), names).select(F.xxhash64(*names).alias("_hash"))


def test_hot_keys_take_another_route_to_the_same_rows(spark):
    left, right = skewed_tables(spark)
    right = right.withColumn("k", F.col("k").cast("bigint"))
    left = left.withColumn("k", F.col("k").cast("bigint"))
    hot = hot_keys(right, ["k"], rows_per_task=20)
    assert rows(hot) == rows(hashes(spark, (7,), names=["k"]))
    plain = left.join(right, ["k"], "left")
    # Keys that only the left side has, or none, may be routed too.
    for route in ([(7,)], [(7,), (399,)], [(399,), (-1,)], [(k,) for k in range(100)]):
        split = left_join_on_keys(left, right, ["k"], hashes(spark, *route, names=["k"]))
        assert split.columns == plain.columns
        assert rows(split) == rows(plain)


def test_hot_keys_of_several_columns(spark):
    left = spark.range(300).select(
        F.concat(F.lit("c"), F.col("id") % 3).alias("c"), (F.col("id") % 20).alias("p"), F.col("id").alias("l")
    )
    right = spark.range(300).select(
        F.when(F.col("id") < 100, "c1").otherwise(F.concat(F.lit("c"), F.col("id") % 3)).alias("c"),
        F.when(F.col("id") < 100, 4).when(F.col("id") == 200, None).otherwise(F.col("id") % 25).alias("p"),
        F.col("id").alias("r"),
    )
    hot = hot_keys(right, ["c", "p"], rows_per_task=50)
    assert rows(hot) == rows(hashes(spark, ("c1", 4), names=["c", "p"]))
    for route in ([("c1", 4)], [("c1", 4), ("c2", 4), ("c1", 5)]):
        joined = left_join_on_keys(left, right, ["c", "p"], hashes(spark, *route, names=["c", "p"]))
        assert rows(joined) == rows(left.join(right, ["c", "p"], "left"))


def test_null_keys_are_not_hot(spark):
    df = spark.range(1000).select(F.when(F.col("id") > 900, F.col("id")).alias("k"))
    assert hot_keys(df, ["k"], rows_per_task=100) is None


def test_no_hot_keys_in_even_data(spark):
    assert hot_keys(spark.range(10000), ["id"], rows_per_task=1) is None
    assert hot_keys(spark.range(10000), ["id"]) is None


def test_merge_keeps_passing_variants_and_multiplies(spark):
    variants = spark.createDataFrame(
        [("chr1", 1, "A", "T", "PASS", 0.5, 1), ("chr1", 2, "A", "T", "AC0", 0.1, 1), ("chr1", 3, "A", "T", None, 0.2, 1), ("chr2", 4, "A", "T", "PASS", 0.3, 1)],
        "contigName string, start bigint, referenceAllele string, alternateAllele string, filters string, INFO_AF double, INFO_AN int",
    )
    notes = spark.createDataFrame(
        [("chr1", 1, "A", "T", "G1", 1.0), ("chr1", 1, "A", "T", "G2", 1.0), ("chr1", 3, "A", "T", "G3", 1.0)],
        "chromosome string, start_position bigint, refallele string, altallele string, genename string, gnomAD_x double",
    )
    merged = merge_annotations(variants, notes)
    assert merged.columns == ["chromosome", "start_position", "refallele", "altallele", "INFO_AF", "genename"]
    assert rows(merged) == [
        ("chr1", 1, "A", "T", 0.5, "G1"),
        ("chr1", 1, "A", "T", 0.5, "G2"),
        ("chr2", 4, "A", "T", 0.3, None),
    ]


def test_null_frequency_drops_the_row_or_adds_nothing(spark):
    df = spark.createDataFrame([(1, 0.5, 0.1, 0.1), (2, 0.5, 0.1, None)], "id int, a double, b double, c double")
    pairs = {"x": (F.col("a"), F.col("b")), "y": (F.col("b"), F.col("c"))}
    assert rows(df.filter(differs_only_in(pairs, "x", 0.05)), "id") == [(1,)]
    total = pairwise_divergence([F.col("a"), F.col("b"), F.col("c")])
    assert rows(df.select("id", total)) == [(1, 0.8), (2, 0.4)]


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "k string")
    counts = [tuple(r) for r in analytics.value_counts(df, "k").collect()]
    assert counts == [("c", 2), ("a", 1), ("b", 1), (None, 1)]
    assert analytics.value_counts(df, "k", k=2).count() == 2


def test_share_of_total(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert [tuple(r) for r in analytics.share_of_total(df, "k").collect()] == [(None, 1, 33.333), (1, 2, 66.667)]
    known = analytics.share_of_total(df, "k", where=F.col("k").isNotNull(), by_share=True)
    assert [tuple(r) for r in known.collect()] == [(1, 2, 100.0)]
    assert analytics.share_of_total(df.limit(0), "k").count() == 0


def test_conditional_rate_counts_null_only_in_total(spark):
    df = spark.createDataFrame([("a", 0.001), ("a", None), ("a", 0.5)], "c string, af double")
    rate = analytics.conditional_rate(df, "c", F.col("af") <= 0.01, ["n", "rare", "pct"])
    assert rows(rate) == [("a", 3, 1, 33.33)]


def test_divergence_top_k_equals_plain_join(spark):
    """Repeated gene names and repeated variants, against the direct formulation."""
    variants = spark.range(400).select(
        F.concat(F.lit("chr"), F.col("id") % 3).alias("chromosome"),
        (F.col("id") % 50).alias("start_position"),
        ((F.col("id") % 7) / 10).alias("x"),
        ((F.col("id") % 5) / 10).alias("y"),
        F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 == 1, "").otherwise(
            F.concat(F.lit("g"), F.col("id") % 9)
        ).alias("genename"),
    )
    genes = spark.range(12).select(
        F.concat(F.lit("g"), F.col("id") % 6).alias("Gene_name"), F.concat(F.lit("t"), "id").alias("text")
    )
    keys = ["chromosome", "start_position"]
    for k in (1, 10, 25, 1000):
        ours = analytics.pairwise_divergence_topk(variants, ["x", "y"], genes, keys, {"text": "text"}, k=k)
        plain = (
            variants.filter("genename IS NOT NULL AND genename != ''")
            .withColumn("af_diff", F.round(F.abs(F.col("x") - F.col("y")), 3))
            .join(genes, F.col("genename") == F.col("Gene_name"))
            .orderBy(F.desc("af_diff"), *keys, "genename", "text")
            .limit(k)
            .select(*keys, "af_diff", "text")
        )
        assert rows(ours) == rows(plain)


def test_divergence_keeps_rows_that_tie_only_after_rounding(spark):
    """0.1004 and 0.0996 both round to 0.1; position decides, not the raw value."""
    variants = spark.createDataFrame(
        [(5, 0.1004, 0.0, "g"), (1, 0.0996, 0.0, "g"), (2, 0.0994, 0.0, "g"), (0, 9.0, 0.0, "unknown")],
        "pos int, x double, y double, genename string",
    )
    genes = spark.createDataFrame([("g", "t"), ("h", "u")], "Gene_name string, text string")
    top = lambda k, v=variants: rows(
        analytics.pairwise_divergence_topk(v, ["x", "y"], genes, ["pos"], {"text": "text"}, k=k)
    )
    assert top(1) == [(1, 0.1, "t")]
    assert top(2) == [(1, 0.1, "t"), (5, 0.1, "t")]
    assert top(25) == [(1, 0.1, "t"), (2, 0.099, "t"), (5, 0.1, "t")]
    assert top(25, variants.filter("genename = 'unknown'")) == []


def test_gene_column_in_any_spelling(spark, sf_dir):
    variants, genes = derived.merged_variants(spark, sf_dir), derived.genes(spark, sf_dir)
    first = rows(reports.divergent_variants(variants, genes))
    lower = genes.toDF(*[c.lower() for c in genes.columns])
    cleaned = clean_names(genes, strict=True)
    assert rows(reports.divergent_variants(variants, lower)) == first
    assert rows(reports.divergent_variants(variants, cleaned)) == first
    with pytest.raises(ValueError, match="KEGG"):
        reports.divergent_variants(variants, genes.drop("Pathway(KEGG)_full"))


def test_duration_text(spark):
    df = spark.createDataFrame([(5025.5,), (0.0,), (359999.25,)], "s double")
    texts = [r[0] for r in df.select(duration_text(F.col("s"))).collect()]
    assert texts == ["1.0h23.0m45.50s", "0.0h0.0m0.00s", "99.0h59.0m59.25s"]


# Relations that hold between reports


def counts_by(df):
    return {r[0]: r["count"] for r in df.collect()}


def test_shares_sum_to_hundred(spark, sf_dir):
    variants = derived.merged_variants(spark, sf_dir)
    for report in (reports.frequency_range_share, reports.significance_share):
        result = report(variants)
        total = result.agg(F.sum(result.columns[-1])).first()[0]
        assert abs(total - 100) < 0.001 * result.count()


def test_directions_add_up(spark, sf_dir):
    variants = derived.merged_variants(spark, sf_dir)
    for report in (reports.sex_difference_counts, reports.east_asian_difference_counts):
        both, up, down = (
            counts_by(report(variants, "clinvar_clnsig", d, k=None)) for d in (None, "up", "down")
        )
        assert both == {k: up.get(k, 0) + down.get(k, 0) for k in both}


def test_overview_equals_single_reports(spark, sf_dir):
    variants = derived.merged_variants(spark, sf_dir).cache()
    suite = reports.difference_suite(variants)
    assert len(suite) == 10
    for name, part in suite.items():
        assert [tuple(r) for r in part.collect()] == [
            tuple(r) for r in reports.REPORTS[name](variants, None).collect()
        ], name
    variants.unpersist()


def test_overview_keeps_values_that_only_one_direction_lists(spark):
    """31 labels; the ones that lead upward have few rows in all."""
    data = [(f"label{i:02d}", -1.0) for i in range(25) for _ in range(10)]
    data += [(f"rare{i}", 1.0) for i in range(6) for _ in range(5 - i % 2)]
    df = spark.createDataFrame(data, "label string, gap double")
    overview = analytics.difference_reports(df, {"label": 25}, F.col("gap"), 0.5, F.abs("gap") >= 0.5)
    up = [tuple(r) for r in analytics.report_of(overview, "label", "up").collect()]
    assert up == [("rare0", 5), ("rare2", 5), ("rare4", 5), ("rare1", 4), ("rare3", 4), ("rare5", 4)]
    assert analytics.report_of(overview, "label").count() == 25
    assert analytics.report_of(overview, "label", "down").count() == 25


def test_even_keys_are_not_shuffled_to_find_hot_ones(spark, monkeypatch):
    """Only buckets with more rows than a task should join have their keys counted."""
    monkeypatch.setattr(annotate, "_COUNT_BUCKETS", 16)
    even = spark.range(8000).withColumn("k", F.col("id") % 4000)
    written = []
    plain = annotate.scratch_path
    monkeypatch.setattr(annotate, "scratch_path", lambda *a: written.append(plain(*a)) or written[-1])
    assert hot_keys(even, ["k"], rows_per_task=2000) is None and len(written) == 1
    mixed = even.withColumn("k", F.when(F.col("id") % 4 == 0, 7).otherwise(F.col("k")))
    hot = hot_keys(mixed, ["k"], rows_per_task=1500)
    assert [tuple(r) for r in hot.collect()] == [tuple(spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first())]
