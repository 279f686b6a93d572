"""Projections that change the shape of a table; each is one ``select``."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.functions.columns import quoted

# Key columns of the annotation files and their names here.
ANNOTATION_KEY_NAMES = {
    "#chr": "chromosome",
    "pos(1-based)": "start_position",
    "ref": "refallele",
    "alt": "altallele",
}
MERGE_KEYS = ["chromosome", "start_position", "refallele", "altallele"]
VARIANT_KEYS = ["contigName", "start", "referenceAllele", "alternateAllele"]


def flatten_structs(df: DataFrame) -> DataFrame:
    """Replace each top-level struct by its fields, named ``{struct}_{field}``.

    Other columns keep their order; the fields follow them.
    """
    plain = [quoted(f.name) for f in df.schema if not isinstance(f.dataType, T.StructType)]
    fields = [
        quoted(f.name).getField(inner.name).alias(f"{f.name}_{inner.name}")
        for f in df.schema
        if isinstance(f.dataType, T.StructType)
        for inner in f.dataType
    ]
    return df.select(*plain, *fields)


def _explode(df: DataFrame, kept: Sequence[str], alternates: str, name: str) -> DataFrame:
    """One row per element of ``alternates`` with its ``_index``; none for a NULL or empty array.

    The plain generator would have Spark filter on the array's size below it, which
    splits every text line again for each condition.
    """
    exploded = df.select(
        *[quoted(c) for c in kept], F.posexplode_outer(quoted(alternates)).alias("_index", name)
    )
    return exploded.filter(F.col("_index").isNotNull())


def explode_alternates(
    df: DataFrame,
    alternates: str = "alternateAlleles",
    name: str = "alternateAllele",
    align: Sequence[str] | None = None,
) -> DataFrame:
    """One row per alternate allele, other arrays reduced to that allele's element.

    A NULL or empty array of alternates gives no row. By default every other
    array is indexed, also those that are not per allele: ``filters`` holds
    ``['PASS']`` for the first allele and NULL for the second. ``align`` limits
    this to the named arrays and leaves the others whole.
    """
    arrays = {f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)} - {alternates}
    if align is not None:
        arrays &= set(align)
    kept = [c for c in df.columns if c != alternates]
    exploded = _explode(df, kept, alternates, name)
    return exploded.select(
        *[F.get(quoted(c), F.col("_index")).alias(c) if c in arrays else quoted(c) for c in kept],
        quoted(name),
    )


def _of_allele(values: Column, index: Column, number: str) -> Column:
    """What an array holds for one alternate; ``index`` counts alternates from 0.

    Genotypes of alleles j <= k are stored at k(k+1)/2 + j.
    """
    if number == "A":
        return F.get(values, index)
    alternate = index + 1
    if number == "R":
        places = [F.lit(0), alternate]
    else:
        mixed = (alternate * (alternate + 1) / 2).cast("int")
        places = [F.lit(0), mixed, mixed + alternate]
    parts = F.array(*[F.get(values, place) for place in places])
    return F.when(values.isNotNull(), parts)


def explode_by_number(
    df: DataFrame,
    numbers: Mapping[str, str],
    alternates: str = "alternateAlleles",
    name: str = "alternateAllele",
) -> DataFrame:
    """One row per alternate allele, arrays reduced as their declared number says.

    ``numbers`` gives the Number of VCF for array columns. ``A`` (one value per
    alternate) becomes that alternate's value; ``R`` (one per allele) the values
    of the reference and the alternate; ``G`` (one per genotype of two alleles)
    those of the genotypes without, with one and with two copies of the
    alternate. Any other number, and any array that is not named, stays whole. An
    array shorter than declared gives NULL in the places it lacks.
    """
    arrays = {f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)} - {alternates}
    kinds = {c: n for c, n in numbers.items() if c in arrays and n in ("A", "R", "G")}
    kept = [c for c in df.columns if c != alternates]
    exploded = _explode(df, kept, alternates, name)
    index = F.col("_index")
    return exploded.select(
        *[_of_allele(quoted(c), index, kinds[c]).alias(c) if c in kinds else quoted(c) for c in kept],
        quoted(name),
    )


def rename_columns(df: DataFrame, names: Mapping[str, str] = ANNOTATION_KEY_NAMES) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def clean_names(df: DataFrame, strict: bool = False) -> DataFrame:
    """``.`` to ``_`` in column names; ``strict`` replaces every odd character."""
    pattern = r"[^A-Za-z0-9_]" if strict else r"\."
    return df.toDF(*[re.sub(pattern, "_", c) for c in df.columns])


def prefix_values(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.withColumn(column, F.concat(F.lit(prefix), quoted(column)))


def numeric_position(df: DataFrame, column: str = "start_position") -> DataFrame:
    """Text positions as numbers, NULL where they are not numbers.

    Done once at ingest: a join of a number with text would raise on the first
    bad value, and a sort of text puts 10 before 9.
    """
    return df.withColumn(column, quoted(column).try_cast("bigint"))


def frequency_columns(columns: Iterable[str]) -> list[str]:
    """Allele-frequency columns by name, in any case."""
    return [
        c
        for c in columns
        if "_af_" in c.lower() or c.lower().startswith("af_") or c.lower().endswith("_af")
    ]


def annotation_columns(
    columns: Iterable[str], keys: Sequence[str] = MERGE_KEYS, drop_prefix: str = "gnomAD"
) -> list[str]:
    """Columns that are neither keys nor a repeat of the frequency source."""
    return [c for c in columns if c not in keys and not c.startswith(drop_prefix)]
