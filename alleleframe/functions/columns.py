"""Column expressions; every one stays inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column by its literal name, however odd (dots, brackets, ``#``)."""
    return F.col("`" + name.replace("`", "``") + "`")


def fixed_width_bin(value: Column, width: float = 0.05) -> Column:
    """Lower edge of the bin that holds ``value``, in plain double arithmetic.

    Edges such as 0.15 or 0.3 fall one bin low, because 0.15 / 0.05 is just
    below 3. Existing results depend on that, so it is not repaired.
    """
    return F.floor(value / F.lit(width)) * F.lit(width)


def signed_difference(left: Column, right: Column) -> Column:
    return left - right


def absolute_difference(left: Column, right: Column) -> Column:
    return F.abs(left - right)


def pairwise_divergence(values: Sequence[Column], digits: int | None = 3) -> Column:
    """Sum of absolute differences over all pairs; a pair with NULL adds 0."""
    terms = [F.coalesce(F.abs(a - b), F.lit(0.0)) for a, b in combinations(values, 2)]
    total = reduce(add, terms)
    return total if digits is None else F.round(total, digits)


def duration_text(seconds: Column) -> Column:
    """``5025.5`` as ``1.0h23.0m45.50s``: hours and minutes as whole doubles."""
    s = seconds.cast("double")
    hours = F.floor(s / 3600).cast("double")
    minutes = F.floor((s % 3600) / 60).cast("double")
    return F.format_string("%.1fh%.1fm%.2fs", hours, minutes, s % 60)
