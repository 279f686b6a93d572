"""Scratch folders and shuffle sizing."""

from __future__ import annotations

import os

import pytest

from alleleframe.session import drop_scratch, scratch_path, size_shuffles
from alleleframe.sinks.storage import (
    range_layout,
    save_external_table,
    scan_size,
    source_bytes,
    write_clustered,
    write_parquet,
)


def test_scratch_folders_are_fresh_and_below_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert root is None or first.startswith(root)


def test_only_own_scratch_is_dropped(spark, tmp_path):
    path = scratch_path(spark, "drop")
    write_parquet(spark.range(3), path)
    drop_scratch(spark, path)
    assert not os.path.exists(path)
    write_parquet(spark.range(3), str(tmp_path / "kept"))
    with pytest.raises(ValueError, match="not a scratch folder"):
        drop_scratch(spark, str(tmp_path / "kept"))
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 3


def test_staged_copy_is_gone_after_a_clustered_write(spark, tmp_path):
    parent = os.path.dirname(scratch_path(spark, "stage"))
    staged = lambda: {n for n in os.listdir(parent) if n.startswith("stage-")}
    before = staged() if os.path.isdir(parent) else set()
    written = write_clustered(spark.range(100), str(tmp_path / "out"), ["id"])
    assert staged() == before
    assert written.count() == 100


def test_a_failing_write_leaves_no_staged_copy(spark, tmp_path):
    parent = os.path.dirname(scratch_path(spark, "stage"))
    staged = lambda: {n for n in os.listdir(parent) if n.startswith("stage-")}
    before = staged() if os.path.isdir(parent) else set()
    with pytest.raises(Exception, match="nope"):
        write_clustered(spark.range(100), str(tmp_path / "out"), ["nope"])
    assert staged() == before


def test_a_hundred_terabytes_have_a_bounded_shuffle(spark, conf):
    conf(spark__sql__shuffle__partitions="8")
    assert size_shuffles(spark, 100 << 40) < 100_000
    ranges, rows_per_file = range_layout(100 << 40, 10**12)
    assert ranges <= 30_000
    assert rows_per_file > 0
    assert range_layout(1 << 40, 10**10) == (4096, 0)


def test_shuffles_grow_with_input_and_never_shrink(spark, conf, tmp_path):
    conf(spark__sql__shuffle__partitions="8")
    assert size_shuffles(spark, 10) == 8
    assert size_shuffles(spark, 1280 * 1024 * 1024 * 100 + 1) == 101
    assert size_shuffles(spark, 0) == 101
    write_parquet(spark.range(1000), str(tmp_path / "a"))
    sizes = [
        os.path.getsize(tmp_path / "a" / f) for f in os.listdir(tmp_path / "a") if f.startswith("part-")
    ]
    assert scan_size(spark.read.parquet(str(tmp_path / "a"))) == (sum(sizes), 1000)
    save_external_table(spark.read.parquet(str(tmp_path / "a")), "sized", str(tmp_path / "b"))
    assert source_bytes(spark, [str(tmp_path / "a"), "sized"]) > sum(sizes)
