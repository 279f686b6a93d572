"""Exact duplicates: counting quotient filters, merged, then byte verification.

Texts are equal when they are identical after lower-casing A-Z. Every partition
puts the 64-bit fingerprints of its texts into counting quotient filters, one
per block of the fingerprint space: the leading bits name the block, the next
bits are the quotient, the rest is the remainder. A filter keeps a bit per
quotient that occurs, and for the remainders, in order, a slot each with bits
that end a quotient's run and that mark a slot as the count of the remainder
before it. Filters hold whole fingerprints, so filters of a block merge without
loss by merging their sorted remainders and adding counts. A hot text is one
slot in every partition's filter, not one row per copy.

Only documents whose fingerprint counts above one are routed to verification:
there whole normalised texts are grouped, so equality is that of all bytes, with
partial groups before the shuffle.

Nulls: a null text counts as empty; a null ``doc_id`` never stays if a copy has
one. Rows that repeat both id and text count each and have one verdict, as have
copies that all lack an id; ``without_copies`` keeps exactly one row of these,
too. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.llm.arrays import text_bytes
from alleleframe.llm.common import ascii_lower, one_per_class, shuffle_width, staged, table, whole_text

#: Fingerprints of all documents per block, on average.
PER_BLOCK = 1 << 20
#: Fingerprints a partition holds before it writes its filters.
HELD = 1 << 22


def encode_filter(prints: np.ndarray, counts: np.ndarray, block_bits: int) -> bytes:
    """The filter of sorted distinct fingerprints of one block."""
    quotient_bits = max(1, math.ceil(math.log2(max(2, len(prints)))))
    rest_bits = 64 - block_bits - quotient_bits
    quotients = (prints >> np.uint64(rest_bits)) & np.uint64((1 << quotient_bits) - 1)
    remainders = prints & np.uint64((1 << rest_bits) - 1)
    several = counts > 1
    place = np.arange(len(prints)) + np.cumsum(several) - several
    slots = np.zeros(len(prints) + int(several.sum()), np.uint64)
    slots[place] = remainders
    slots[place[several] + 1] = counts[several]
    counter = np.zeros(len(slots), bool)
    counter[place[several] + 1] = True
    run_end = np.zeros(len(slots), bool)
    last = np.append(quotients[1:] != quotients[:-1], True)
    run_end[(place + several)[last]] = True
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotients.astype(np.int64)] = True
    width = max(1, (int(slots.max()).bit_length() + 7) // 8)
    head = np.array([quotient_bits, width, len(slots)], "<u4").tobytes()
    bits = b"".join(np.packbits(x).tobytes() for x in (occupied, run_end, counter))
    raw = slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return head + bits + raw


def decode_filter(data: bytes, block: int, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints and counts of a filter."""
    quotient_bits, width, n = (int(x) for x in np.frombuffer(data, "<u4", 3))
    at, found = 12, []
    for size in (1 << quotient_bits, n, n):
        packed = np.frombuffer(data, np.uint8, (size + 7) // 8, at)
        found.append(np.unpackbits(packed, count=size).astype(bool))
        at += len(packed)
    occupied, run_end, counter = found
    raw = np.zeros((n, 8), np.uint8)
    raw[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    slots = raw.reshape(-1).view("<u8")
    run = np.cumsum(run_end) - run_end
    quotients = np.flatnonzero(occupied).astype(np.uint64)[run]
    rest_bits = 64 - block_bits - quotient_bits
    prints = (
        (np.uint64(block) << np.uint64(64 - block_bits) if block_bits else np.uint64(0))
        | (quotients << np.uint64(rest_bits))
        | slots
    )[~counter]
    counts = np.ones(len(prints), np.uint64)
    counts[(np.cumsum(~counter) - 1)[counter]] = slots[counter]
    return prints, counts


def merge_filters(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted fingerprints with their counts."""
    prints = np.concatenate([p for p, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
    return prints[first], np.add.reduceat(counts, first)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fingerprint and sha256 of the normalised text, one row per document."""
    rows = docs.select("doc_id", whole_text().alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("text_hash", T.LongType()),
            T.StructField("fingerprint", T.LongType()),
            T.StructField("digest", T.BinaryType()),
        ]
    )

    def read(batches):
        for batch in batches:
            data, marks = text_bytes(batch.column("text"))
            data = data.tobytes()
            found = [
                hashlib.sha256(data[a:b].lower()).digest()  # bytes: only A-Z change
                for a, b in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True)
            ]
            prints = np.frombuffer(b"".join(found), "<i8")[::4] if found else np.zeros(0, "<i8")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(prints, pa.int64()),
                    pa.array(found, pa.binary()),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(read, schema)


def partition_filters(prints: DataFrame, block_bits: int) -> DataFrame:
    """Filters of every partition: block, filter."""

    def flush(held):
        prints, counts = np.unique(np.concatenate(held), return_counts=True)
        blocks = prints >> np.uint64(64 - block_bits) if block_bits else prints * np.uint64(0)
        first = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
        ends = np.append(first[1:], len(prints))
        filters = [
            encode_filter(prints[a:b], counts[a:b].astype(np.uint64), block_bits)
            for a, b in zip(first, ends, strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks[first].astype(np.int64)), pa.array(filters, pa.binary())],
            names=["block", "filter"],
        )

    def build(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
                size += batch.num_rows
            if size >= HELD:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return prints.select("fingerprint").mapInArrow(build, "block bigint, filter binary")


def merged_filters(filters: DataFrame, block_bits: int) -> DataFrame:
    """One filter per block."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        block = int(group["block"].iloc[0])
        prints, counts = merge_filters([decode_filter(x, block, block_bits) for x in group["filter"]])
        return pd.DataFrame({"block": [block], "filter": [encode_filter(prints, counts, block_bits)]})

    return filters.groupBy("block").applyInPandas(merge, "block bigint, filter binary")


def repeated_fingerprints(filters: DataFrame, block_bits: int) -> DataFrame:
    """Fingerprints that merged filters count more than once."""

    def read(batches):
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                prints, counts = decode_filter(data, block, block_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints[counts > 1].view(np.int64))], names=["fingerprint"]
                )

    return filters.mapInArrow(read, "fingerprint bigint")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, keep_id, group_size, kept, text_sha256: one row per document."""
    spark = docs.sparkSession
    found = staged(digests(docs), "exact-digests")
    blocks = shuffle_width(spark, found.count(), PER_BLOCK)
    block_bits = max(0, math.ceil(math.log2(blocks)))
    filters = merged_filters(partition_filters(found, block_bits), block_bits)
    routed = found.join(repeated_fingerprints(filters, block_bits), "fingerprint", "left_semi")
    routed = routed.select(F.col("doc_id").alias("routed_id"), F.col("text_hash").alias("routed_hash"))
    texts = docs.select("doc_id", whole_text().alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text")).join(
        routed,
        F.col("doc_id").eqNullSafe(F.col("routed_id")) & (F.col("text_hash") == F.col("routed_hash")),
        "left_semi",
    )
    groups = (
        texts.groupBy(ascii_lower(F.col("text")).alias("same"))
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(F.unhex(F.sha2("same", 256)).alias("digest"), "keep_id", "group_size")
    )
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.join(groups, "digest", "left").select(
        "doc_id",
        "text_hash",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each text, with their columns."""
    found = exact_groups(docs).where("group_size > 1").withColumnRenamed("text_sha256", "class")
    return one_per_class(docs, found, "exact")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("text_hash")


SQL = {
    "op1_exact_dedup": """
WITH normal AS (SELECT doc_id, sha256(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, MAX(doc_id) OVER w AS keep_id, COUNT(*) OVER w AS group_size,
 doc_id IS NOT DISTINCT FROM MAX(doc_id) OVER w AS kept, text_sha256
FROM normal WINDOW w AS (PARTITION BY text_sha256)
""",
}
