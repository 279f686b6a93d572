"""VCF text files as one Spark job.

The driver keeps the different headers only. Records stay a single declarative plan:
text scan, split on tabs, one ``from_json`` over the INFO text, typed columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.sources import block_gzip

# VCF header types and the Spark types they are read as.
SPARK_TYPES = {
    "Integer": "bigint",
    "Float": "double",
    "String": "string",
    "Character": "string",
}

# Declared fields up to which each is looked up in the INFO text by itself.
_MOST_LOOKUPS = 16

_ATTRIBUTE = re.compile(r"[<,](ID|Number|Type)=([^,>]+)")


@dataclass(frozen=True)
class InfoField:
    """One ``##INFO`` declaration."""

    name: str
    number: str
    type: str

    @property
    def is_flag(self) -> bool:
        return self.type == "Flag"

    @property
    def line(self) -> str:
        return f"##INFO=<ID={self.name},Number={self.number},Type={self.type}>"

    @property
    def is_array(self) -> bool:
        return self.number not in ("0", "1")


def header_lines(spark: SparkSession, path: str) -> list[str]:
    """Leading ``#`` lines of one file; ``take`` stops after its first lines."""
    lines = spark.read.text(path)
    size = 1024
    while True:
        head = [row.value for row in lines.take(size)]
        if len(head) < size or not head[-1].startswith("#"):
            return [line for line in head if line.startswith("#")]
        size *= 4


def all_headers(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """The different headers of many files, each under the first file that has it.

    One job reads the leading lines of all files. Files of a chromosome set mostly
    share one header, and only different ones come to the driver.
    """
    found = (
        block_gzip.headers_of(spark, files)
        .groupBy("digest")
        .agg(F.min(F.struct("path", "lines")).alias("first"))
        .select("first.*")
    )
    return {row.path: list(row.lines) for row in found.orderBy("path").collect()}


def info_fields(header: Iterable[str]) -> list[InfoField]:
    fields = []
    for line in header:
        if line.startswith("##INFO="):
            found = dict(_ATTRIBUTE.findall(line))
            fields.append(InfoField(found["ID"], found["Number"], found["Type"]))
    return fields


def common_fields(headers: dict[str, list[str]]) -> list[InfoField]:
    """INFO fields of all files; a field declared in two ways raises."""
    fields: dict[str, InfoField] = {}
    for path, header in headers.items():
        if not any(line.startswith("##") for line in header):
            raise ValueError(f"no VCF header found in {path}; name the file that has it with header=")
        for field in info_fields(header):
            if fields.setdefault(field.name, field) != field:
                raise ValueError(f"INFO field {field.name} of {path} is declared otherwise elsewhere")
    return list(fields.values())


def _info_as_json(info: Column) -> Column:
    """``A=1;B`` to ``{"A":"1","B":""}``, in one linear pass.

    A map would be searched from its start for every declared field, which is
    quadratic on the hundreds of INFO fields of a population VCF; a repeated
    key would also raise. Here the last one wins. Entries without a name become
    members without a name, which nothing reads.
    """
    escaped = F.replace(info, F.lit("\\"), F.lit("\\\\"))
    escaped = F.replace(escaped, F.lit('"'), F.lit('\\"'))
    members = F.regexp_replace(escaped, r";*(?:([^;=]++)(?:=([^;]*+))?|=[^;]*+);*", '"$1":"$2",')
    return F.concat(F.lit("{"), F.rtrim(members, F.lit(",")), F.lit("}"))


def _lookup(entries: Column, name: str) -> Column:
    """Text of one field of ``;A=1;B;``; empty if it has no value, NULL if it is absent.

    The last entry of that name wins. Only a name that also stands without ``=``
    needs a pattern to tell which entry is last.
    """
    mark, bare = F.lit(f";{name}="), F.lit(f";{name};")
    last = F.substring_index(F.substring_index(entries, f";{name}=", -1), ";", 1)
    either = F.regexp_extract(entries, rf"(?s).*;\Q{name}\E(?:=([^;]*+))?;", 1)
    return F.when(F.contains(entries, bare), either).when(F.contains(entries, mark), last)


def _typed(raw: Column, field: InfoField) -> Column:
    if field.is_flag:
        return raw.isNotNull()
    spark_type = SPARK_TYPES[field.type]
    missing_as_null = lambda text: F.nullif(text, F.lit("."))
    if field.is_array:
        parts = F.split(raw, ",")
        if spark_type == "string":
            return F.transform(parts, missing_as_null)
        # Text that is no number costs an exception when cast, so the common missing mark is not.
        missing = F.array(F.lit(None).cast(spark_type))
        return F.when(raw == ".", missing).otherwise(parts.try_cast(f"array<{spark_type}>"))
    return missing_as_null(raw) if spark_type == "string" else missing_as_null(raw).try_cast(spark_type)


def _list_or_null(text: Column, separator: str) -> Column:
    return F.when(text != ".", F.split(text, separator))


def parse_vcf_lines(
    lines: DataFrame, fields: Sequence[InfoField], one_based: bool = True
) -> DataFrame:
    """Records of a ``value`` column of VCF lines, INFO as one typed struct.

    ``one_based=True`` keeps POS, so positions meet the annotation tables;
    ``False`` gives the 0-based start that common VCF readers return.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    records = lines.filter(~F.col("value").startswith("#") & (F.col("value") != "")).select(
        F.split("value", "\t", 9).alias("part")
    )
    part = lambda i: F.get("part", F.lit(i))
    position = part(1).try_cast("bigint")
    columns = [
        part(0).alias("contigName"),
        (position if one_based else position - 1).alias("start"),
        (position + F.length(part(3)) - 1).alias("end"),
        _list_or_null(part(2), ";").alias("names"),
        part(3).alias("referenceAllele"),
        _list_or_null(part(4), ",").alias("alternateAlleles"),
        F.nullif(part(5), F.lit(".")).try_cast("double").alias("qual"),
        _list_or_null(part(6), ";").alias("filters"),
    ]
    if not fields:
        return records.select(*columns)
    if len(fields) <= _MOST_LOOKUPS:
        entries = F.concat(F.lit(";"), part(7), F.lit(";")).alias("_entries")
        found = records.select(*columns, entries)
        texts = [_lookup(F.col("_entries"), f.name).alias(f"_raw{i}") for i, f in enumerate(fields)]
        found = found.select(*found.columns[:-1], *texts)
        info = F.struct(*[_typed(F.col(f"_raw{i}"), f).alias(f.name) for i, f in enumerate(fields)])
        return found.select(*found.columns[: len(columns)], info.alias("INFO"))
    options = {"allowUnquotedControlChars": "true", "mode": "FAILFAST"}
    parsed = F.from_json(_info_as_json(part(7)), text_schema, options)
    raw = F.col("_info")
    info = F.struct(*[_typed(raw.getField(f.name), f).alias(f.name) for f in fields])
    with_info = records.select(*columns, parsed.alias("_info"))
    return with_info.select(*with_info.columns[:-1], info.alias("INFO"))


def _read_lines(
    spark: SparkSession, paths: Sequence[str], files: list[tuple[str, int]], block_gzip_files: bool | None
) -> DataFrame:
    """``value``: the lines of all files; block-gzip ones are split over tasks."""
    split = [f for f in files if f[0].endswith(".bgz") or (block_gzip_files and f[0].endswith(".gz"))]
    if not split:
        return spark.read.text(list(paths))
    lines = block_gzip.read_lines(spark, split)
    rest = [path for path, _ in files if (path, _) not in set(split)]
    return lines.unionByName(spark.read.text(rest)) if rest else lines


def declared_fields(
    spark: SparkSession, paths: str | Sequence[str], header: str | Iterable[str] | None = None
) -> list[InfoField]:
    """INFO fields of all files, or of ``header``: a path or the lines themselves."""
    if header is None:
        paths = [paths] if isinstance(paths, str) else list(paths)
        return common_fields(all_headers(spark, [path for path, _ in block_gzip.listed(spark, paths)]))
    if isinstance(header, str):
        return common_fields({header: header_lines(spark, header)})
    return common_fields({"header": list(header)})


def read_vcf(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: str | Iterable[str] | None = None,
    fields: Sequence[str] | None = None,
    one_based: bool = True,
    block_gzip_files: bool | None = None,
) -> DataFrame:
    """Scan VCF files with one schema, such as one file per chromosome.

    By default the header of every file is read: fields of all files are kept,
    and a field that two files declare in different ways raises. ``header``, a
    path or the lines themselves, stands for all files; what it does not declare
    is not read. ``fields`` keeps only some INFO fields. Plain text and block-gzip
    files (``.bgz``, and ``.gz`` if ``block_gzip_files`` is set) are split over
    tasks; any other gzip file is one task.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = block_gzip.listed(spark, paths)
    if header is None:
        declared = common_fields(all_headers(spark, [path for path, _ in files]))
    else:
        declared = declared_fields(spark, paths, header)
    if fields is not None:
        unknown = set(fields) - {f.name for f in declared}
        if unknown:
            raise ValueError(f"INFO fields not declared in the header: {sorted(unknown)}")
        declared = [f for f in declared if f.name in set(fields)]
    return parse_vcf_lines(_read_lines(spark, paths, files, block_gzip_files), declared, one_based)
