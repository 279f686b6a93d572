"""Parametric report operators.

Every grouping aggregates before it shuffles, so a hot group costs one row per
task. Sorts name the key as tie-break and state where NULL goes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alleleframe.functions.columns import pairwise_divergence, quoted


def _matching(df: DataFrame, where: Column | None) -> DataFrame:
    return df if where is None else df.filter(where)


def row_count(df: DataFrame, where: Column | None = None, name: str = "cnt") -> DataFrame:
    """One-row relation with the number of rows."""
    return _matching(df, where).agg(F.count("*").alias(name))


def preview(df: DataFrame, n: int = 10, order: Sequence[str] = ()) -> DataFrame:
    """At most ``n`` rows to print; which ones is only fixed with ``order``."""
    ordered = df.orderBy(*[quoted(c).asc_nulls_first() for c in order]) if order else df
    return ordered.limit(n)


def value_counts(
    df: DataFrame, key: str, where: Column | None = None, k: int | None = 25
) -> DataFrame:
    """Rows per value of ``key``, NULL included, most frequent first."""
    counts = _matching(df, where).groupBy(quoted(key)).agg(F.count("*").alias("count"))
    ordered = counts.orderBy(F.desc("count"), quoted(key).asc_nulls_last())
    return ordered if k is None else ordered.limit(k)


def share_of_total(
    df: DataFrame,
    key: str,
    where: Column | None = None,
    k: int | None = None,
    by_share: bool = False,
    digits: int = 3,
) -> DataFrame:
    """Rows per value of ``key`` and their percentage of all rows counted.

    The total is a scalar subquery over the group counts, not over ``df``: it
    reuses their shuffle, so the table is scanned once.
    """
    share = f"{key}_percentage"
    counts = _matching(df, where).groupBy(quoted(key)).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    shares = counts.withColumn(share, F.round(F.col("count") / total * 100, digits))
    if by_share:
        ordered = shares.orderBy(F.desc(share), quoted(key).asc_nulls_last())
    else:
        ordered = shares.orderBy(quoted(key).asc_nulls_first())
    return ordered if k is None else ordered.limit(k)


def conditional_rate(
    df: DataFrame,
    key: str,
    condition: Column,
    names: Sequence[str],
    k: int | None = None,
    digits: int = 2,
) -> DataFrame:
    """Per ``key``: all rows, rows meeting ``condition``, and their percentage.

    ``names`` are the three output names. Where ``condition`` is NULL the row
    counts only in the total.
    """
    total, hits, percent = names
    hit_count = F.count(F.when(condition, 1))
    rates = df.groupBy(quoted(key)).agg(
        F.count("*").alias(total),
        hit_count.alias(hits),
        F.round(hit_count / F.count("*") * 100, digits).alias(percent),
    )
    ordered = rates.orderBy(quoted(key).asc_nulls_first())
    return ordered if k is None else ordered.limit(k)


def difference_reports(
    df: DataFrame,
    keys: dict[str, int | None],
    signed: Column,
    threshold: float,
    where: Column,
) -> DataFrame:
    """Three reports for each of ``keys`` from one scan: either way, upward, downward.

    ``keys`` gives the number of values each report has (None: all). One row per
    (dimension, value) that is in any report: rows meeting ``where``, how many of
    them differ upward and downward by ``threshold``, and the place in each
    report, NULL where the value is not in it. The single reports would scan the
    table once each; here one scan makes the counts, and three short lists per
    dimension are drawn from them, cut in every task before they meet.
    """
    dimension, value, limit = F.lit(None), F.lit(None), F.lit(None).cast("int")
    for key, k in keys.items():
        in_set = F.grouping(quoted(key)) == 0
        dimension = F.when(in_set, F.lit(key)).otherwise(dimension)
        value = F.when(in_set, quoted(key).cast("string")).otherwise(value)
        limit = F.when(in_set, F.lit(k).cast("int")).otherwise(limit)
    counts = (
        df.filter(where)
        .groupingSets([[quoted(key)] for key in keys], *[quoted(key) for key in keys])
        .agg(
            dimension.alias("dimension"),
            value.alias("value"),
            limit.alias("limit"),
            F.count("*").alias("count"),
            F.count(F.when(signed >= threshold, 1)).alias("count_up"),
            F.count(F.when(signed <= -threshold, 1)).alias("count_down"),
        )
        .select("dimension", "value", "limit", "count", "count_up", "count_down")
    )
    places = {"count": "place", "count_up": "place_up", "count_down": "place_down"}
    lists = F.array(*[F.struct(F.lit(p).alias("list"), F.col(c).alias("n")) for c, p in places.items()])
    order = Window.partitionBy("dimension", "list").orderBy(
        F.desc("n"), F.col("value").asc_nulls_last()
    )
    ranked = (
        counts.select("*", F.inline(lists))
        .where("n > 0")
        .withColumn("rank", F.row_number().over(order))
    )
    if None not in keys.values():
        # With a plain bound each task keeps its own first rows before they meet in one per list.
        ranked = ranked.where(F.col("rank") <= max(keys.values()))
    listed = ranked.where(F.coalesce(F.col("rank") <= F.col("limit"), F.lit(True)))
    # A value is in at most three lists.
    return listed.groupBy("dimension", "value").agg(
        *[F.max(c).alias(c) for c in places],
        *[F.max(F.when(F.col("list") == p, F.col("rank"))).alias(p) for p in places.values()],
    )


def report_of(overview: DataFrame, dimension: str, direction: str | None = None) -> DataFrame:
    """One single report out of the rows of ``difference_reports``."""
    end = f"_{direction}" if direction else ""
    return (
        overview.filter((F.col("dimension") == dimension) & F.col(f"place{end}").isNotNull())
        .orderBy(f"place{end}")
        .select(F.col("value").alias(dimension), F.col(f"count{end}").alias("count"))
    )


def extent_by_key(
    df: DataFrame,
    key: str,
    value: str,
    names: Sequence[str],
    where: Column | None = None,
    k: int | None = 25,
) -> DataFrame:
    """Smallest and largest ``value`` per ``key``, largest first."""
    low, high = names
    extents = (
        _matching(df, where)
        .groupBy(quoted(key))
        .agg(F.min(quoted(value)).alias(low), F.max(quoted(value)).alias(high))
    )
    ordered = extents.orderBy(F.col(high).desc_nulls_last(), quoted(key).asc_nulls_last())
    return ordered if k is None else ordered.limit(k)


def pairwise_divergence_topk(
    df: DataFrame,
    values: Sequence[str],
    genes: DataFrame,
    variant_columns: Sequence[str],
    gene_columns: Mapping[str, str],
    key: str = "genename",
    gene_key: str = "Gene_name",
    k: int = 25,
    digits: int = 3,
) -> DataFrame:
    """The ``k`` variants inside a known gene with the largest divergence.

    Three steps, each on less data than a sort of the full join:

    1. The ``k``-th largest unrounded divergence, from the frequencies and the
       gene name alone.
    2. Only variants that can round to at least that value are rounded, read
       with all their columns, and cut to ``k`` rows. Rounding keeps the order
       and moves a value by less than one unit of the last digit, so none that
       belongs to the result is lost, ties included.
    3. Gene texts may be long; they meet only those ``k`` rows. Rows sort by
       variant before gene columns, so each of the first ``k`` joined rows
       belongs to one of the first ``k`` variants.
    """
    total = pairwise_divergence([quoted(v) for v in values], digits=None)
    named = df.filter(quoted(key).isNotNull() & (quoted(key) != ""))
    known = genes.select(quoted(gene_key).alias("_gene")).distinct()
    totals = named.select(quoted(key).alias("_gene"), total.alias("_total"))
    largest = totals.join(known, "_gene", "left_semi").orderBy(F.desc("_total")).limit(k)
    bound = largest.agg(F.min("_total")).scalar() - 2 * 10.0**-digits

    variant_order = [
        F.col("af_diff").desc_nulls_last(),
        *[quoted(c).asc_nulls_last() for c in variant_columns],
        F.col("_gene").asc_nulls_last(),
    ]
    candidates = named.filter(total >= bound).select(
        *[quoted(c) for c in variant_columns],
        F.round(total, digits).alias("af_diff"),
        quoted(key).alias("_gene"),
    )
    top = candidates.join(known, "_gene", "left_semi").orderBy(*variant_order).limit(k)

    texts = genes.select(
        quoted(gene_key).alias("_gene"),
        *[quoted(old).alias(new) for old, new in gene_columns.items()],
    )
    gene_order = [quoted(new).asc_nulls_last() for new in gene_columns.values()]
    return (
        top.join(texts, "_gene", "inner")
        .orderBy(*variant_order, *gene_order)
        .limit(k)
        .select(*map(quoted, variant_columns), "af_diff", *map(quoted, gene_columns.values()))
    )
