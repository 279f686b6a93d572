"""The physical plans the operators are written for."""

from __future__ import annotations

import re

import pytest
from conftest import final_plan
from pyspark.sql import functions as F

from alleleframe.operators.annotate import hot_keys, left_join_on_keys
from alleleframe.operators import analytics
from alleleframe.plans import reports, sql_reports
from alleleframe.sinks.storage import write_clustered, write_parquet
from checks import derived


@pytest.fixture(scope="module")
def published(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("published")
    merged = write_clustered(
        derived.merged_variants(spark, sf_dir), str(folder / "merged"), ["chromosome", "start_position"]
    )
    write_parquet(derived.genes(spark, sf_dir), str(folder / "genes"))
    return merged, spark.read.parquet(str(folder / "genes"))


def final(plan: str) -> str:
    return plan.split("== Initial Plan ==")[0]


def test_share_scans_the_table_once(published):
    report = reports.frequency_range_share(published[0])
    plan = final_plan(report)
    assert "ReusedExchange" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # All scans that ran, the subquery's too, read the table's rows once in all.
    assert scanned_rows(report) == published[0].count()


def scanned_rows(df) -> int:
    """Output rows of the file scans of an executed plan, subqueries included."""

    def nodes(plan):
        kind = plan.getClass().getSimpleName()
        if kind.startswith("AdaptiveSparkPlan"):
            yield from nodes(plan.executedPlan())
        elif "QueryStage" in kind:
            yield from nodes(plan.plan())
        elif not kind.startswith("Reused"):
            yield plan
            for group in (plan.children(), plan.subqueries()):
                for i in range(group.size()):
                    yield from nodes(group.apply(i))

    total = 0
    for node in nodes(df._jdf.queryExecution().executedPlan()):
        kind = node.getClass().getSimpleName()
        if kind.startswith("SubqueryExec"):
            continue
        if kind.startswith("FileSourceScan"):
            total += node.metrics().apply("numOutputRows").value()
    return total


@pytest.mark.parametrize("name", sorted(reports.REPORTS))
def test_reports_stay_in_the_jvm_and_prune(published, name):
    plan = final_plan(reports.REPORTS[name](*published))
    assert "TakeOrderedAndProject" in plan
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    read = ",".join(re.findall(r"ReadSchema: struct<(.*?)>", plan))
    assert "chromosome" in read or "clinvar" in read or "info_af" in read
    assert ("info_af_mid_xx" in read) == ("eas_only" in name)
    assert ("function_description" in read) == (name == "q17_divergent_variants")


def test_filters_reach_the_scan(published):
    plan = final_plan(reports.REPORTS["q04_sex_diff_by_chromosome"](*published))
    assert "GreaterThanOrEqual(AF_XX_MINUS_AF_XY_ABS,0.05)" in plan
    plan = final_plan(reports.REPORTS["q15_reviewed_pathogenic_by_gene"](*published))
    assert "EqualTo(clinvar_review,reviewed_by_expert_panel)" in plan


def test_divergence_broadcasts_by_size_and_works_without(published, conf):
    df = reports.divergent_variants(*published)
    assert "BroadcastHashJoin" in final_plan(df)
    expected = df.collect()
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    shuffled = reports.divergent_variants(*published)
    assert "SortMergeJoin" in final(final_plan(shuffled))
    assert shuffled.collect() == expected


def test_pass_filter_is_below_the_join(spark, sf_dir):
    from checks.registered import annotate_left_join

    plan = annotate_left_join(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    join, filter_ = plan.index("Join LeftOuter"), plan.index("= PASS")
    assert filter_ > join


def test_one_scan_for_related_reports(published):
    plan = final(final_plan(reports.sex_difference_overview(published[0])))
    assert plan.count("FileScan") == 1


def test_adaptive_execution_splits_hot_keys_on_either_side(spark, conf):
    """Small thresholds stand in for large data: hot partitions are split."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="40KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    text = F.sha2(F.col("id").cast("string"), 512)
    few = spark.range(0, 2000, 1, 8).select(F.col("id").alias("k"), F.lit("x").alias("note"))

    def many(key):
        return spark.range(0, 60000, 1, 8).select(key.alias("k"), text.alias("payload"))

    third = many(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")))
    assert "skew=true" in final(final_plan(left_join_on_keys(third, few, ["k"])))
    # One key with a third of the rows, one with 0.9 %, and a thousand keys with 60 rows each.
    cases = {
        "third": (third, 1000, 1),
        "small share": (many(F.when(F.col("id") % 111 == 0, 5).otherwise(F.col("id"))), 300, 1),
        "many keys": (many(F.pmod("id", F.lit(1000))), 50, 1000),
    }
    for name, (right, rows_per_task, n) in cases.items():
        hot = hot_keys(right, ["k"], rows_per_task)
        assert hot.count() == n, name
        joined = left_join_on_keys(few, right, ["k"], hot)
        plan = final(final_plan(joined))
        assert name == "many keys" or "skew=true" in plan, name
        plain = few.join(right, ["k"], "left")
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty(), name


def test_lists_of_an_overview_are_cut_before_they_meet(published):
    """Each task keeps its first rows of every dimension; the counts are made once."""
    overview = reports.sex_difference_overview(published[0])
    plan = final(final_plan(overview))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert scanned_rows(overview) <= published[0].count()


def test_an_overview_without_sizes_lists_every_value(spark):
    df = spark.range(300).selectExpr("CAST(id % 60 AS string) AS a", "CAST(id % 7 AS string) AS b", "1.0D AS gap")
    found = analytics.difference_reports(df, {"a": None, "b": 2}, F.col("gap"), 0.5, F.lit(True))
    assert found.where("dimension = 'a'").count() == 60
    assert sorted(r.place for r in found.where("dimension = 'b'").collect()) == [1, 2]
    assert found.where("place_down IS NOT NULL").count() == 0


def test_sql_texts_take_tables_and_values_by_name(spark, published, tmp_path):
    published[0].createOrReplaceTempView("text_variants")
    names = {"variants": "text_variants"}
    share = sql_reports.run_text(spark, "q01_af_range_share", names)
    assert share.collect() == reports.REPORTS["q01_af_range_share"](published[0], None).limit(1000).collect()
    rare = sql_reports.run_text(spark, "q02_rare_rate_by_chromosome", names, {"rare": 0.01, "k": 24})
    assert rare.collect() == reports.REPORTS["q02_rare_rate_by_chromosome"](published[0], None).collect()
    own = "SELECT COUNT(*) AS n FROM IDENTIFIER(:variants) WHERE chromosome = :chromosome"
    odd = sql_reports.run_text(spark, own, names, {"chromosome": "x' OR '1' = '1"})
    assert odd.first().n == 0
