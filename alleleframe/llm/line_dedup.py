"""Substring dedup by hashing lines and the clauses in them.

A text is cut into units: after line ends and after marks that end a sentence or
a clause, so a passage inside longer lines is a row of whole units but for its
ends. Units are normalised (A-Z in lower case, white space as one space, none at
the ends) and named by a 128-bit digest; those of marks and white space alone are
left out. Digests are grouped over all documents. A unit is repeated if its digest
is met again anywhere; short ones are so by chance, so a unit alone says little:
what counts are runs of repeated units next to each other. In runs with a size of
``RUN`` or more, the occurrence of each unit with the smallest (doc_id, unit)
stays and every other one is removed, with its code point offsets kept. The size
of a unit is its number of words, or a tenth of its bytes if that is more: scripts
without spaces have no words to count.

First only digests are counted; then units meet the repeated digests, and only
units that are repeated, a small part of all, move on with their documents. A
unit that very many documents share is one partial row per task in the counts,
and in the joins it is a key that adaptive execution splits.

Nulls: a null text has no units; a null ``doc_id`` ranks last. Rows that repeat
an id and a text are the same document, so they do not remove each other's
units; texts that differ are different documents, also under one id or none. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.llm.common import staged, table, whole_text

#: Size of a run of repeated units from which on it is a passage.
RUN = 40
#: Marks after which a unit ends.
MARKS = ".!?,;:\n\u3002\uff01\uff1f\uff0c\uff1b\uff1a\u3001"
_UNIT = re.compile(f"[^{MARKS}]*[{MARKS}]+|[^{MARKS}]+")


def unit_rows(text: str):
    """start, end, size, digest of every unit with content."""
    start = 0
    for piece in _UNIT.findall(text):
        end = start + len(piece)
        words = piece.encode().lower().split()  # of bytes: A-Z and ASCII white space only
        plain = b" ".join(words)
        if plain.decode().strip(MARKS + " "):
            yield start, end, max(len(words), len(plain) // 10), hashlib.md5(plain, usedforsecurity=False).digest()
        start = end


def units(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, high, low (the digest), place (start and end), unit (number and size) of every unit."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            *(T.StructField(n, T.LongType()) for n in ("text_hash", "high", "low", "place", "unit")),
        ]
    )

    def read(batches):
        for batch in batches:
            ids, hashes, texts = batch.columns
            for first in range(0, batch.num_rows, 64):
                rows, found = [], ([], [], [], [])
                for row in range(first, min(first + 64, batch.num_rows)):
                    for number, (start, end, size, digest) in enumerate(unit_rows(texts[row].as_py())):
                        rows.append(row)
                        high, low = struct.unpack("<qq", digest)
                        for column, value in zip(found, (high, low, start << 32 | end, number << 32 | size), strict=True):
                            column.append(value)
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), hashes.take(take), *(pa.array(column, pa.int64()) for column in found)],
                    names=schema.names,
                )

    texts = docs.select("doc_id", F.xxhash64(whole_text()).alias("text_hash"), whole_text().alias("text"))
    return texts.mapInArrow(read, schema)


def _in_runs(repeated: DataFrame, least: int) -> DataFrame:
    """The repeated units of each document that lie in runs of ``least`` or more, with the run's size."""
    # Equal rows of a document become one before they are moved.
    by_document = repeated.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("unit", "place", "high", "low")).alias("units")
    )
    names = ("unit", "start", "end", "size", "run_size", "high", "low")
    schema = T.StructType(
        [*repeated.select("doc_id", "text_hash").schema, *(T.StructField(n, T.LongType()) for n in names)]
    )

    def runs(batches):
        for batch in batches:
            ids, hashes, lists = batch.columns
            rows, found = [], tuple([] for _ in names)
            for row, some in enumerate(lists):
                columns = {n: some.values.field(n).to_pylist() for n in ("unit", "place", "high", "low")}
                entries = sorted(zip(*columns.values(), strict=True))
                begin = 0
                for i in range(1, len(entries) + 1):
                    if i < len(entries) and entries[i][0] >> 32 == (entries[i - 1][0] >> 32) + 1:
                        continue
                    run = entries[begin:i]
                    begin = i
                    total = sum(unit & 0xFFFFFFFF for unit, *_ in run)
                    if total < least:
                        continue
                    for unit, place, high, low in run:
                        rows.append(row)
                        values = (unit >> 32, place >> 32, place & 0xFFFFFFFF, unit & 0xFFFFFFFF, total, high, low)
                        for column, value in zip(found, values, strict=True):
                            column.append(value)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), hashes.take(take), *(pa.array(column, pa.int64()) for column in found)],
                names=schema.names,
            )

    return by_document.mapInArrow(runs, schema)


def repeated_units(docs: DataFrame, least: int = RUN) -> DataFrame:
    """The units to remove: their offsets, their run's size, and the occurrence that stays."""
    found = staged(units(docs), "line-units")
    # Written out, so that the joins are of two shuffles and a hot digest can be split among tasks.
    several = found.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    several = staged(several, "line-digests")
    repeated = staged(found.join(several, ["high", "low"], "left_semi"), "line-repeats")
    rank = F.struct(
        F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", F.shiftright("unit", 32).alias("unit")
    )
    first = repeated.groupBy("high", "low").agg(F.min(rank).alias("first"), F.count("*").alias("copies"))
    first = staged(first, "line-first")
    stays = (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("text_hash") == F.col("first.text_hash"))
        & (F.col("unit") == F.col("first.unit"))
    )
    return (
        _in_runs(repeated, least)
        .join(first, ["high", "low"])
        .where(~stays)
        .select(
            "doc_id",
            "unit",
            "start",
            "end",
            "size",
            "run_size",
            F.col("first.doc_id").alias("first_doc_id"),
            F.col("first.unit").alias("first_unit"),
            "copies",
            F.lower(F.concat(_hex_of("high"), _hex_of("low"))).alias("digest"),
            "text_hash",
        )
    )


def _hex_of(name: str):
    """Hex digits of a long, its lowest byte first."""
    digits = F.lpad(F.hex(name), 16, "0")
    return F.concat(*[F.substring(digits, i, 2) for i in range(15, 0, -2)])


def without_repeats(docs: DataFrame, least: int = RUN) -> DataFrame:
    """doc_id, text without the removed units, removed: their (start, end) in the original text."""
    gone = repeated_units(docs, least).groupBy(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash")).agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed")
    )
    rows = docs.select("doc_id", whole_text().alias("text"), F.xxhash64(whole_text()).alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("hash"))
    rows = rows.join(gone, same, "left").select("doc_id", "text", "removed")

    names = rows.columns

    def cut(batches):
        for batch in batches:
            texts = []
            for text, removed in zip(batch.column("text"), batch.column("removed"), strict=True):
                text, parts, at = text.as_py(), [], 0
                for span in removed.as_py() or ():
                    parts.append(text[at : span["start"]])
                    at = span["end"]
                texts.append("".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), batch.column("removed")], names=names
            )

    return rows.mapInArrow(cut, rows.schema)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_units(table(spark, sf_dir, "documents")).drop("text_hash")


_SQL_MARKS = r".!?,;:\n\x{3002}\x{FF01}\x{FF1F}\x{FF0C}\x{FF1B}\x{FF1A}\x{3001}"
SQL = {
    "op3_line_dedup": rf"""
WITH pieces AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''),
  '[^{_SQL_MARKS}]*[{_SQL_MARKS}]+|[^{_SQL_MARKS}]+') AS l FROM documents),
placed AS (SELECT doc_id, unnest(l) AS piece, unnest(range(len(l))) AS i FROM pieces),
offsets AS (SELECT *, COALESCE(SUM(length(piece)) OVER (PARTITION BY doc_id ORDER BY i
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM placed),
normal AS (SELECT *, trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain FROM offsets),
filled AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS unit,
  greatest(length(plain) - length(replace(plain, ' ', '')) + 1, strlen(plain) // 10) AS size
  FROM normal WHERE regexp_matches(plain, '[^ {_SQL_MARKS}]')),
ranked AS (SELECT *, COUNT(*) OVER (PARTITION BY plain) AS copies,
  FIRST_VALUE(doc_id) OVER w AS first_doc_id, FIRST_VALUE(unit) OVER w AS first_unit FROM filled
  WINDOW w AS (PARTITION BY plain ORDER BY doc_id, unit)),
islands AS (SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS island
  FROM ranked WHERE copies > 1),
runs AS (SELECT *, SUM(size) OVER (PARTITION BY doc_id, island)::BIGINT AS run_size FROM islands)
SELECT doc_id, unit, start, start + length(piece) AS "end", size, run_size, first_doc_id, first_unit,
 copies, md5(plain) AS digest FROM runs
WHERE run_size >= {RUN} AND (doc_id, unit) <> (first_doc_id, first_unit)
""",
}
