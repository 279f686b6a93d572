"""Every registered query against DuckDB on the same Parquet files."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from alleleframe.operators import metering
from alleleframe.sinks import storage
from checks import oracles, registered
from checks.compare import connect, differences

QUERIES = registered.all_queries()
SQL = oracles.all_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_oracle(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, SQL[name]) == []


def test_stored_size_counts_the_files(spark, sf_dir):
    import os

    paths = [f"{sf_dir}/{n}.parquet" for n in ("lineitem", "part", "orders")]
    row = metering.storage_cost(storage.stored_size(spark, paths), 0.024).first()
    sizes = [os.path.getsize(f"{sf_dir}/{n}.parquet") for n in ("lineitem", "part", "orders")]
    assert row.total_bytes == sum(sizes)
    assert row.monthly_cost == sum(sizes) / 1024**3 * 0.024


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["info_af_range", "count", "info_af_range_percentage"]
    assert result.count() > 0
