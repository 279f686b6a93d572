"""Layout, tables, statistics."""

from __future__ import annotations

import os

import pytest
from conftest import final_plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from alleleframe.operators.annotate import merge_annotations
from alleleframe.session import held_settings
from alleleframe.sinks import bucketed, statistics, storage, warehouse
from alleleframe.sinks.statistics import collect_statistics, column_statistics

KEYS = ["chromosome", "position"]


def variants(spark, n=20000):
    """A third of the rows are exact copies of one row."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.when(hot, "chr1").otherwise(F.concat(F.lit("chr"), F.col("id") % 5)).alias("chromosome"),
        F.when(hot, 7).otherwise(F.xxhash64("id") % 100000).alias("position"),
        F.when(hot, "x").otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("text"),
    )


def test_file_count():
    mb = 1024 * 1024
    assert [storage.target_file_count(x * mb) for x in (0, 1, 256, 511, 512, 25600)] == [1, 1, 1, 1, 2, 100]


def test_stored_size_equals_files(spark, tmp_path):
    path = str(tmp_path / "p")
    storage.write_parquet(variants(spark), path, partition_by=["chromosome"])
    sizes = [
        os.path.getsize(os.path.join(d, f))
        for d, _, files in os.walk(path)
        for f in files
        if not f.startswith((".", "_"))
    ]
    assert storage.stored_size(spark, path).first().total_bytes == sum(sizes)


def test_clustered_files_are_ranges_of_similar_size(spark, tmp_path):
    """The hot key spreads over several files and every file is sorted."""
    staged = str(tmp_path / "staged")
    storage.write_parquet(variants(spark), staged)
    source = spark.read.parquet(staged)
    clustered = storage.cluster_files(source, KEYS, 8)
    parts = clustered.select(*KEYS).rdd.glom().map(lambda p: [tuple(r) for r in p]).collect()
    assert len(parts) == 8
    assert max(map(len, parts)) < 2 * 20000 / 8
    flat = [row for part in parts for row in part]
    assert flat == sorted(flat)
    assert clustered.exceptAll(source).isEmpty() and source.exceptAll(clustered).isEmpty()


def test_write_clustered(spark, tmp_path):
    df = variants(spark)
    written = storage.write_clustered(df, str(tmp_path / "out"), KEYS, target_mb=1)
    assert rows(written) == rows(df)
    files = [f for f in os.listdir(tmp_path / "out") if f.endswith(".parquet")]
    assert len(files) == max(int(sum(os.path.getsize(tmp_path / "out" / f) for f in files) / 2**20), 1)
    by_chromosome = storage.write_clustered(
        df, str(tmp_path / "parts"), KEYS, partition_by=["chromosome"]
    )
    assert rows(by_chromosome, *df.columns) == rows(df)
    plan = by_chromosome.filter("chromosome = 'chr2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chromosome" in plan


def test_load_must_not_be_empty(spark, tmp_path):
    source = str(tmp_path / "empty")
    storage.write_parquet(spark.range(0), source)
    with pytest.raises(RuntimeError, match="t_empty"):
        warehouse.load_checked(spark, source, "t_empty", str(tmp_path / "t"))


def test_empty_source_leaves_the_old_table(spark, tmp_path):
    full, empty = str(tmp_path / "full"), str(tmp_path / "none")
    storage.write_parquet(spark.range(5), full)
    storage.write_parquet(spark.range(0), empty)
    warehouse.load_checked(spark, full, "t_kept", str(tmp_path / "t"))
    with pytest.raises(RuntimeError, match="t_kept"):
        warehouse.load_checked(spark, empty, "t_kept", str(tmp_path / "t"))
    assert spark.table("t_kept").count() == 5


def test_load_is_typed_clustered_and_analysed(spark, tmp_path):
    source = str(tmp_path / "source")
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS k", "concat('v', id) AS v")
    storage.write_parquet(df.repartition(4), source)
    loaded = warehouse.load_checked(spark, source, "t_load", str(tmp_path / "t"), keys=["k"])
    assert rows(loaded) == rows(df)
    types = {r.col_name: r.data_type for r in spark.sql("DESCRIBE t_load").collect()}
    assert types["v"] == "varchar(9)"
    (load,) = os.listdir(tmp_path / "t")
    files = [f for f in os.listdir(tmp_path / "t" / load) if f.endswith(".parquet")]
    assert files
    for name in files:
        keys = [r.k for r in spark.read.parquet(str(tmp_path / "t" / load / name)).collect()]
        assert keys == sorted(keys)
    assert column_statistics(spark, "t_load", ["k"]).first()["max"] == "999"
    # Widths of a further load come from these statistics.
    assert warehouse.stored_widths(spark, "t_load") == {"v": 9}
    again = warehouse.load_checked(spark, "t_load", "t_again", str(tmp_path / "t2"), keys=["k"])
    assert rows(again) == rows(df)


def test_a_load_that_fails_half_way_leaves_the_old_table(spark, tmp_path):
    source, wide = str(tmp_path / "source"), str(tmp_path / "wide")
    storage.write_parquet(spark.range(50).selectExpr("id AS k", "concat('v', id) AS v"), source)
    warehouse.load_checked(spark, source, "t_swap", str(tmp_path / "t"), keys=["k"])
    before = sorted(os.listdir(tmp_path / "t"))
    storage.write_parquet(spark.range(90).selectExpr("id AS k", "repeat('w', int(id)) AS v"), wide)
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH"):
        warehouse.create_typed_table(
            spark.read.parquet(wide), "t_swap", str(tmp_path / "t"), ["k"], widths={"v": 40}
        )
    assert spark.table("t_swap").count() == 50
    assert sorted(os.listdir(tmp_path / "t")) == before
    with pytest.raises(RuntimeError, match="missing"):
        def refuse(fresh):
            raise RuntimeError("rows are missing")
        warehouse.create_typed_table(spark.read.parquet(wide), "t_swap", str(tmp_path / "t"), accept=refuse)
    assert spark.table("t_swap").count() == 50
    assert [t.name for t in spark.catalog.listTables() if "t_swap_load" in t.name] == []


def test_a_load_takes_the_place_of_the_old_one(spark, tmp_path):
    for n in (50, 90):
        source = str(tmp_path / f"source{n}")
        storage.write_parquet(spark.range(n).selectExpr("id AS k", f"repeat('w', {n}) AS v"), source)
        loaded = warehouse.load_checked(spark, source, "t_place", str(tmp_path / "t"), keys=["k"])
        assert loaded.count() == n
        assert len(os.listdir(tmp_path / "t")) == 1
    types = {r.col_name: r.data_type for r in spark.sql("DESCRIBE t_place").collect()}
    assert types["v"] == "varchar(95)"
    assert column_statistics(spark, "t_place", ["k"]).first()["max"] == "89"


def test_loads_are_cut_into_files_and_stale_widths_are_measured(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "MOST_RANGES", 2)
    monkeypatch.setattr(storage, "target_file_count", lambda *a: 8)
    path = str(tmp_path / "s")
    storage.save_external_table(spark.range(4000).selectExpr("id AS k", "concat('v', id % 10) AS v"), "t_stale", path)
    collect_statistics(spark, "t_stale")
    more = spark.range(4000, 4400).selectExpr("id AS k", "repeat('long', 9) AS v")
    more.write.mode("append").parquet(path)  # the catalog does not notice
    spark.catalog.refreshTable("t_stale")
    assert warehouse.stored_widths(spark, "t_stale", 4000) == {"v": 7}
    assert warehouse.stored_widths(spark, "t_stale", 4400) == {}
    loaded = warehouse.load_checked(spark, "t_stale", "t_cut", str(tmp_path / "t"), keys=["k"])
    assert loaded.count() == 4400
    (load,) = os.listdir(tmp_path / "t")
    assert len([f for f in os.listdir(tmp_path / "t" / load) if f.endswith(".parquet")]) >= 8
    assert spark.conf.get("spark.sql.files.maxRecordsPerFile") == "0"


def test_a_replaced_shard_leaves_the_files_of_others(spark, tmp_path):
    path = str(tmp_path / "release")
    df = variants(spark, 3000)
    storage.write_clustered(df, path, KEYS, partition_by=["chromosome"])
    names = lambda: {
        d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
        for d in os.listdir(path)
        if "=" in d
    }
    before = names()
    fresh = spark.range(40).selectExpr("'chr2' AS chromosome", "id AS position", "'new' AS text")
    with pytest.raises(ValueError, match="chr2"):
        storage.replace_shards(fresh, path, ["position"], ["chromosome"], [("chr3",)])
    assert names() == before
    result = storage.replace_shards(fresh, path, ["position"], ["chromosome"], [("chr2",)])
    after = names()
    assert {d: f for d, f in after.items() if d != "chromosome=chr2"} == {
        d: f for d, f in before.items() if d != "chromosome=chr2"
    }
    assert after["chromosome=chr2"] != before["chromosome=chr2"]
    kept = df.where("chromosome != 'chr2'")
    assert rows(result, *df.columns) == sorted(rows(kept) + rows(fresh), key=repr)


def plain_and_bucketed(spark, rows_per_task=None):
    """A third of the annotations share one key."""
    n = spark.range(3000)
    left = n.selectExpr(
        "concat('chr', id % 5) AS contigName", "id AS start", "'A' AS referenceAllele",
        "'T' AS alternateAllele", "'PASS' AS filters", "id / 3000 AS INFO_AF",
    )
    hot = F.col("id") % 3 == 0
    right = n.select(
        F.when(hot, "chr1").otherwise(F.concat(F.lit("chr"), F.col("id") % 5)).alias("chromosome"),
        F.when(hot, 1).otherwise(F.col("id")).alias("start_position"),
        F.lit("A").alias("refallele"),
        F.lit("T").alias("altallele"),
        F.sha1(F.col("id").cast("string")).alias("genename"),
    )
    names = (f"bv_{rows_per_task}", f"ba_{rows_per_task}")
    bucketed.bucket_variants(left, right, names, 4, rows_per_task)
    return merge_annotations(left, right), bucketed.merge_bucketed(spark, *names), names


def test_bucketed_tables_join_without_an_exchange(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plain, joined, _ = plain_and_bucketed(spark)
    assert "Exchange" not in final_plan(joined)
    assert "Exchange" in final_plan(plain)
    assert rows(joined) == rows(plain)


def test_hot_keys_are_kept_out_of_buckets(spark):
    plain, joined, names = plain_and_bucketed(spark, rows_per_task=100)
    assert spark.table(names[1] + "_hot").count() == 1001
    assert rows(joined) == rows(plain)


def test_large_tables_get_more_buckets_and_annotations_are_derived_once(spark, monkeypatch):
    """140 bytes a row: 3000 rows are five tasks of 100 kB."""
    monkeypatch.setattr(storage, "RANGE_BYTES", 100_000)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    found = spark.range(3000).selectExpr(
        "concat('chr', id % 5) AS chromosome", "id AS start_position", "'A' AS refallele",
        "'T' AS altallele", "sha1(string(id)) AS genename",
    )
    right = found.mapInArrow(counted, found.schema)
    left = spark.range(3000).selectExpr(
        "concat('chr', id % 5) AS contigName", "id AS start", "'A' AS referenceAllele",
        "'T' AS alternateAllele", "'PASS' AS filters", "id / 3000 AS INFO_AF",
    )
    bucketed.bucket_variants(left, right, ("bv_more", "ba_more"), 2)
    assert seen.value == 3000
    for name in ("bv_more", "ba_more"):
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert described["Num Buckets"] == "8"
    joined = bucketed.merge_bucketed(spark, "bv_more", "ba_more")
    assert rows(joined) == rows(merge_annotations(left, found))


def test_buckets_are_a_power_of_two():
    assert [bucketed.bucket_count(mb * 2**20) for mb in (1, 256, 600, 1025, 10**8)] == [1, 1, 2, 4, 524288]


def test_statistics_of_shards_merge_to_those_of_the_table(spark):
    df = spark.range(20_000).selectExpr(
        "id % 7 AS shard", "id * 450000000000001 AS big", "IF(id % 3 = 0, NULL, concat('t', id % 5000)) AS text",
        "CAST(id AS double) - 10000.5 AS number", "id % 2 = 0 AS flag", "array(id) AS list",
    )
    stored = statistics.shard_statistics(df, "shard")
    assert stored.count() == 7 * 4
    merged = {r.column_name: r for r in statistics.merged_statistics(stored).collect()}
    exact = {
        "big": (20000, 0, None, "0", str(19999 * 450000000000001)),
        "text": (20000, 6667, 5, "t0", "t999"),
        "number": (20000, 0, None, "-10000.5", "9998.5"),
        "flag": (20000, 0, None, "false", "true"),
    }
    for name, values in exact.items():
        r = merged[name]
        assert (r.rows, r.nulls, r.max_length, r["min"], r["max"]) == values, name
    assert abs(merged["big"].distinct_estimate - 20000) < 0.03 * 20000
    assert abs(merged["text"].distinct_estimate - 5000) < 0.03 * 5000
    # The sketches of the shards together are the sketch of the whole.
    whole = statistics.merged_statistics(statistics.shard_statistics(df.withColumn("shard", F.lit(1)), "shard"))
    assert {r.column_name: r.distinct_estimate for r in whole.collect()} == {n: r.distinct_estimate for n, r in merged.items()}


def test_a_new_shard_replaces_its_own_figures_only(spark):
    df = spark.range(90).selectExpr("CAST(id % 3 AS string) AS shard", "id AS v")
    df = df.unionByName(spark.sql("SELECT CAST(NULL AS string) AS shard, CAST(1000 AS bigint) AS v"))
    stored = statistics.shard_statistics(df, "shard")
    fresh = statistics.shard_statistics(spark.sql("SELECT '2' AS shard, CAST(-5 AS bigint) AS v"), "shard")
    merged = statistics.merged_statistics(statistics.with_new_shards(stored, fresh)).first()
    assert (merged.rows, merged["min"], merged["max"]) == (62, "-5", "1000")
    empty = statistics.shard_statistics(df.limit(0), "shard")
    assert statistics.merged_statistics(empty).collect() == []


def test_one_range_holds_several_sorted_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "MOST_RANGES", 2)
    monkeypatch.setattr(storage, "target_file_count", lambda *a: 8)
    out = str(tmp_path / "out")
    written = storage.write_clustered(spark.range(4000).selectExpr("4000 - id AS k"), out, ["k"], codec="zstd")
    assert sorted(r.k for r in written.collect()) == list(range(1, 4001))
    files = sorted(f for f in os.listdir(out) if f.endswith(".parquet"))
    assert len(files) >= 8
    assert len({f.split("-")[1] for f in files}) == 2
    assert all("zstd" in f for f in files)
    for f in files:
        keys = [r.k for r in spark.read.parquet(f"{out}/{f}").collect()]
        assert keys == sorted(keys)


def test_rows_that_compress_well_are_cut_into_ranges_a_task_sorts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "RANGE_BYTES", 100_000, raising=False)
    df = spark.range(20000).selectExpr("20000 - id AS k", "'same' AS v")  # 40 bytes a row
    written = storage.write_clustered(df, str(tmp_path / "out"), ["k"])
    assert rows(written) == rows(df)
    assert len([f for f in os.listdir(tmp_path / "out") if f.endswith(".parquet")]) == 8
    storage.write_parquet(df, str(tmp_path / "source"))
    loaded = warehouse.load_checked(spark, str(tmp_path / "source"), "t_ranges", str(tmp_path / "t"), ["k"])
    assert rows(loaded) == rows(df)
    (load,) = os.listdir(tmp_path / "t")
    assert len([f for f in os.listdir(tmp_path / "t" / load) if f.endswith(".parquet")]) == 8


def test_tasks_that_deal_out_rows_read_splits_of_bounded_rows(spark, tmp_path, monkeypatch):
    mb, name = 2**20, "spark.sql.files.maxPartitionBytes"
    assert storage.split_bytes(100 * mb, 4 * mb, 512) == 25 * mb
    assert storage.split_bytes(100 << 40, 10**12, 500) == (100 << 40) // 100_000
    assert storage.split_bytes(0, 0, 8) == 4 * mb
    path = str(tmp_path / "p")
    df = spark.range(0, 600_000, 1, 1).selectExpr("id AS k", "xxhash64(id) AS a", "xxhash64(id + 1) AS b")
    storage.write_parquet(df, path, codec="none", group_bytes=mb)
    source, before = spark.read.parquet(path), spark.conf.get(name)
    monkeypatch.setattr(storage, "RANGE_BYTES", 4 * mb)
    # 24 bytes a row, hardly compressed: the smallest split is also that of RANGE_BYTES.
    count, _, settings = storage.clustering(source)
    assert count == 4 and 4 * mb <= settings[name] < 6 * mb
    with held_settings(spark, settings):
        parts = spark.read.parquet(path).rdd.glom().map(len).collect()
    assert sum(parts) == 600_000 and max(parts) < 300_000
    assert spark.conf.get(name) == before


def test_typed_table_checks_widths(spark, tmp_path):
    df = spark.createDataFrame([("abc", None, 1.5, 2, True)], "s string, n string, d double, i bigint, b boolean")
    assert warehouse.warehouse_types(df) == {
        "s": "VARCHAR(8)", "n": "VARCHAR(65535)", "d": "FLOAT8", "i": "BIGINT", "b": "BOOLEAN",
    }
    table = warehouse.create_typed_table(df, "typed", str(tmp_path / "typed"))
    assert rows(table) == rows(df)
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH"):
        df.withColumn("s", F.lit("123456789")).write.insertInto("typed")


def test_statistics_quote_names_and_skip_arrays(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "abc", [1]), (2, None, [2])], "`pos(1-based)` bigint, text string, arr array<int>"
    )
    storage.save_external_table(df, "stats", str(tmp_path / "stats"))
    columns = collect_statistics(spark, "stats")
    assert columns == ["pos(1-based)", "text"]
    assert rows(column_statistics(spark, "stats", columns)) == [
        ("pos(1-based)", "1", "2", "0", "2", "8"),
        ("text", None, None, "1", "1", "3"),
    ]
