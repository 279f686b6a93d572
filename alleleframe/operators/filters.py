"""Row filters. A comparison with NULL is unknown and drops the row."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.functions.columns import quoted

# Longest text the warehouses take, and the sex chromosomes.
MAX_TEXT_LENGTH = 65535
SEX_CHROMOSOMES = ["chrX", "chrY"]


def within_length(
    df: DataFrame, limit: int = MAX_TEXT_LENGTH, keep_nulls: bool = False
) -> DataFrame:
    """Rows whose every string column has at most ``limit`` characters.

    A NULL string drops the row too, unless ``keep_nulls`` is set.
    """
    tests = []
    for field in df.schema:
        if isinstance(field.dataType, T.StringType):
            column = quoted(field.name)
            fits = F.length(column) <= limit
            tests.append(fits | column.isNull() if keep_nulls else fits)
    return df.filter(reduce(and_, tests)) if tests else df


def autosomal(chromosome: str = "chromosome") -> Column:
    return ~quoted(chromosome).isin(SEX_CHROMOSOMES)


def differs(
    signed: Column,
    threshold: float,
    direction: str | None = None,
    magnitude: Column | None = None,
) -> Column:
    """A difference of at least ``threshold``.

    ``direction`` is ``"up"`` or ``"down"`` to ask for one sign. A stored
    ``magnitude`` column is compared directly, so that the test reaches the
    Parquet scan.
    """
    if direction == "up":
        return signed >= threshold
    if direction == "down":
        return signed <= -threshold
    return (F.abs(signed) if magnitude is None else magnitude) >= threshold


def differs_only_in(
    pairs: dict[str, tuple[Column, Column]],
    group: str,
    threshold: float,
    direction: str | None = None,
) -> Column:
    """The pair of ``group`` differs and the pairs of all other groups do not."""
    others = [g for g in pairs if g != group]
    left, right = pairs[group]
    own = differs(left - right, threshold, direction)
    return reduce(and_, [F.abs(pairs[g][0] - pairs[g][1]) < threshold for g in others], own)
