"""Registered queries against DuckDB, where SQL can express them."""

from __future__ import annotations

import pytest

from alleleframe.llm import registry
from checks import compare


@pytest.mark.parametrize("name", sorted(registry.all_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    found = registry.all_queries()[name](spark, sf_dir)
    assert compare.differences(found, compare.connect(sf_dir), registry.all_sql()[name]) == []


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.all_queries())
    assert numbers == list(range(1, 14))
