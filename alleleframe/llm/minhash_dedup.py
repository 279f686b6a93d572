"""Near duplicates by MinHash with banding, verified, joined to components.

A document's set holds the hashes of its distinct word shingles, each made of digests
of its words' bytes. Documents with
equal sets form a class at once; all further work is on classes, so exact copies
cost one row each. The signature of a class is the minimum of each of 140
universal hash functions over its set; 28 bands of 5 minima name its buckets.
Two sets with a Jaccard similarity of 0.8 share no bucket with a probability of
1.5e-5, of 0.85 with one of 7e-8.

Pairs of a bucket are never written out. Loose groups come first: every class is
paired with the smallest one of each of its buckets, pairs whose signatures agree
five standard deviations below the threshold or better are joined, and buckets
that still hold several groups are compared in full by signature, in blocks of
bounded size that spread over tasks and hand out one link per class at most. By
then all classes that share a bucket and may be linked are in one loose group.
Inside each loose group, all whole sets are compared, again in blocks, by exact
intersection sizes; each block hands out links that span what it confirmed. The
components of these links are the result (large-star and small-star both times).

Nulls: a null text is empty, has no shingle and is linked with nothing. A null
``doc_id`` takes part; it is never the smallest of a component that has an id.
Rows of a component that repeat its smallest id, or that all lack one, have one
verdict; ``without_near_copies`` keeps exactly one of them. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.llm.arrays import (
    WordDigests,
    shingle_set,
    small_parts,
    spanning,
    text_bytes,
    whole_groups,
    word_digests,
)
from alleleframe.llm.common import one_per_class, staged, table, whole_text
from alleleframe.llm.components import components

BANDS = 28
ROWS = 5
SEED = 20240117
#: Signatures of an open bucket that one task compares with as many others.
BLOCK = 1024
#: Whole sets of a loose group that one task compares with as many others.
SET_BLOCK = 256
#: Shingles per step of an exact comparison.
COLUMNS = 4096
#: Shingles whose hashes are computed at a time.
HELD = 4096


def hash_parameters(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the multiply-shift family, one per place of a signature."""
    draw = np.random.default_rng(seed)
    factors = draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64) << np.uint64(1) | np.uint64(1)
    return factors, draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64) << np.uint64(1)


def signature(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), HELD):
        part = shingles[start : start + HELD]
        np.minimum(least, (part[None, :] * factors[:, None] + offsets[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(48)).astype("<u2")


def set_key(shingles: np.ndarray) -> bytes:
    """Name of a set: 128 bits of a digest of its sorted hashes."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sets(batches, width):
    """Parts of every batch with the shingle sets of their rows."""
    known = WordDigests()
    for batch in batches:
        for part in small_parts(batch):
            data, marks = text_bytes(part.column("text"))
            data, marks = data.tobytes(), marks.tolist()
            texts = (data[a:b] for a, b in zip(marks[:-1], marks[1:], strict=True))
            yield part, [shingle_set(word_digests(text, known), width) for text in texts]


def _hashed(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", whole_text().alias("text"))
    return texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_key, signature; the last two are null for an empty set."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("text_hash", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("signature", T.BinaryType()),
        ]
    )

    def read(batches):
        factors, shifts = hash_parameters()
        for batch, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(
                        [signature(s, factors, shifts).tobytes() if len(s) else None for s in sets],
                        pa.binary(),
                    ),
                ],
                names=schema.names,
            )

    return _hashed(docs).mapInArrow(read, schema)


def whole_sets(texts: DataFrame, width: int) -> DataFrame:
    """``texts`` with shingles (eight bytes each, in order) in place of text.

    Rows that differ in nothing but the text stand for one class: a task hands
    out the first of them only.
    """
    rest = [f for f in texts.schema if f.name != "text"]
    schema = T.StructType([*rest, T.StructField("shingles", T.BinaryType())])

    def fresh(batches):
        seen = set()
        for batch in batches:
            keep = []
            for key in zip(*(batch.column(f.name).to_pylist() for f in rest), strict=True):
                keep.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(keep, pa.bool_()))
            if len(seen) > 1 << 17:
                seen.clear()

    def read(batches):
        for batch, sets in _sets(fresh(batches), width):
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in rest), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=schema.names,
            )

    return texts.mapInArrow(read, schema)


def buckets(classes: DataFrame) -> DataFrame:
    """bucket, set_key: the buckets of every class, over all bands."""
    width = 2 * ROWS
    bands = F.array(
        *[F.xxhash64(F.lit(b), F.substring("signature", 1 + width * b, width)) for b in range(BANDS)]
    )
    return classes.select(F.explode(bands).alias("bucket"), "set_key")


def shared_buckets(classes: DataFrame) -> DataFrame:
    """bucket, set_key, centre (smallest class of the bucket) of buckets with more than one class."""
    every = buckets(classes)
    several = every.groupBy("bucket").agg(F.min("set_key").alias("centre"), F.count("*").alias("n"))
    return every.join(several.where("n > 1").drop("n"), "bucket").select("bucket", "set_key", "centre")


def least_agreement(percent: int) -> float:
    """Share of places in which a pair at the threshold agrees, less five standard deviations."""
    share = percent / 100
    return share - 5 * (share * (1 - share) / (BANDS * ROWS)) ** 0.5


def _signs(column) -> np.ndarray:
    return np.frombuffer(text_bytes(column)[0].tobytes(), "<u2").reshape(-1, BANDS * ROWS)


def star_pairs(shared: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Each class with the smallest class of each of its buckets, if signatures agree."""
    pairs = (
        shared.where("set_key != centre")
        .select(F.col("set_key").alias("node"), F.col("centre").alias("other"))
        .distinct()
    )
    one = classes.select(F.col("set_key").alias("node"), F.col("signature").alias("one"))
    two = classes.select(F.col("set_key").alias("other"), F.col("signature").alias("two"))
    signed = pairs.join(one, "node").join(two, "other").select("node", "other", "one", "two")

    def check(batches):
        for batch in batches:
            agree = (_signs(batch.column("one")) == _signs(batch.column("two"))).mean(axis=1)
            keep = pa.array(agree >= least)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").filter(keep), batch.column("other").filter(keep)],
                names=["node", "other"],
            )

    return signed.mapInArrow(check, "node binary, other binary")


def _in_blocks(members: DataFrame, size: int) -> DataFrame:
    """``members`` with part (8 bytes for ``of``), low, high, block: who meets whom.

    A group named by ``of`` is cut into blocks of about ``size`` rows. Each block
    meets itself and each other block of its group once, as (low, high).
    """
    counts = members.groupBy("of").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    return (
        members.join(counts, "of")
        .withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns(
            {
                "part": F.xxhash64("of"),
                "low": F.least("block", "with"),
                "high": F.greatest("block", "with"),
            }
        )
        .drop("of", "blocks", "with")
    )


_MEETING = ["part", "low", "high"]


def unrepeated(batches):
    """Batches without the rows that repeat the meeting, block and class of the row before."""
    before = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(c).to_pylist() for c in (*_MEETING, "block", "set_key")]
        keys = list(zip(*columns, strict=True))
        keep = [key != last for last, key in zip([before, *keys], keys, strict=False)]
        before = keys[-1]
        yield batch.filter(pa.array(keep, pa.bool_()))


def _spanned(placed: DataFrame, linked) -> DataFrame:
    """node, other: links that span what ``linked(rows, one, other)`` finds in each meeting of blocks."""

    def compare(batches):
        for rows, first in whole_groups(unrepeated(batches), _MEETING):
            low, high, block = (rows.column(c).to_numpy() for c in ("low", "high", "block"))
            keys = rows.column("set_key").combine_chunks()
            found = []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                if b - a > 1:
                    one = a + np.flatnonzero(block[a:b] == low[a])
                    other = one if low[a] == high[a] else a + np.flatnonzero(block[a:b] == high[a])
                    if len(one) and len(other):
                        found.append(spanning(linked(rows, one, other), one, other))
            node = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
            to = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(node)), keys.take(pa.array(to))], names=["node", "other"]
            )

    return (
        placed.repartition(*_MEETING)
        .sortWithinPartitions(*_MEETING, "block", "set_key")
        .mapInArrow(compare, "node binary, other binary")
    )


def open_links(shared: DataFrame, classes: DataFrame, loose: DataFrame, least: float) -> DataFrame:
    """Links that span the agreeing pairs of different loose groups in one bucket."""
    labelled = shared.select("bucket", "set_key").join(
        loose.select(F.col("node").alias("set_key"), "component"), "set_key", "left"
    )
    labelled = labelled.withColumn("component", F.coalesce("component", "set_key"))
    still = labelled.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    members = (
        labelled.join(still.where("a != b").select("bucket"), "bucket")
        .join(classes.select("set_key", "signature"), "set_key")
        .select(F.col("bucket").alias("of"), "set_key", F.xxhash64("component").alias("group"), "signature")
    )

    def linked(rows, one, other):
        first = min(one[0], other[0])
        some = rows.slice(first, max(one[-1], other[-1]) + 1 - first)
        signs, group = _signs(some.column("signature")), some.column("group").to_numpy()
        found = np.zeros((len(one), len(other)), bool)
        for x, i in enumerate((one - first).tolist()):
            apart = np.flatnonzero(group[other - first] != group[i])
            if len(apart):
                agree = (signs[i] == signs[other[apart] - first]).mean(axis=1)
                found[x, apart] = agree >= least
        return found

    return _spanned(_in_blocks(members, BLOCK), linked).distinct()


def common_sizes(sets: list[np.ndarray], n: int) -> np.ndarray:
    """How many members the first ``n`` sets and each of the sets have in common."""
    sizes = [len(s) for s in sets]
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = counts[column] > 1
    owner = np.repeat(np.arange(len(sets)), sizes)[several]
    column = (np.cumsum(counts > 1) - 1)[column[several]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((n, len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        present = np.zeros((len(sets), COLUMNS), np.float32)
        present[owner[a:b], column[a:b] - start] = 1
        total += present[:n] @ present.T  # whole numbers far below 2^24: exact
    return total


def confirmed_links(
    docs: DataFrame, classes: DataFrame, loose: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links that span the pairs whose whole sets have ``percent`` of their union in common."""
    members = classes.select("set_key", "sample").join(
        loose.withColumnRenamed("node", "set_key"), "set_key"
    )
    placed = _in_blocks(members.withColumnRenamed("component", "of"), SET_BLOCK).select(
        *_MEETING,
        "block",
        "set_key",
        F.col("sample.doc_id").alias("wanted_id"),
        F.col("sample.text_hash").alias("wanted_hash"),
    )
    texts = _hashed(docs).join(
        placed,
        F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("text_hash") == F.col("wanted_hash")),
    )
    sets = whole_sets(texts.select(*_MEETING, "block", "set_key", "text"), width)

    def linked(rows, one, other):
        same = one is other
        places = one if same else np.concatenate([one, other])
        column = rows.column("shingles")
        some = [np.frombuffer(column[i].as_buffer(), np.uint64) for i in places.tolist()]
        sizes = np.array([len(s) for s in some])
        common = common_sizes(some, len(one))
        common, right = (common, sizes) if same else (common[:, len(one) :], sizes[len(one) :])
        union = sizes[: len(one), None] + right[None, :] - common
        return 100 * common.astype(np.float64) >= percent * union

    return _spanned(sets, linked)


def _near_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``near_groups`` with class, which names the component; null if the set is empty."""
    signed = staged(signatures(docs, width), "minhash-signatures")
    classes = (
        signed.where("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("text_hash", "doc_id")).alias("sample"),
            F.any_value("signature").alias("signature"),
        )
    )
    classes = staged(classes, "minhash-classes")
    shared = staged(shared_buckets(classes), "minhash-buckets")
    least = least_agreement(percent)
    loose = components(star_pairs(shared, classes, least))
    more = open_links(shared, classes, loose, least)
    loose = components(loose.withColumnRenamed("component", "other").unionByName(more))
    found = components(confirmed_links(docs, classes, loose, width, percent))
    of = classes.select("set_key", "least_id").join(
        found.withColumnRenamed("node", "set_key"), "set_key", "left"
    )
    of = of.withColumn("component", F.coalesce("component", "set_key"))
    named = of.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of = of.join(named, "component").select("set_key", "component_id", F.col("component").alias("class"))
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return signed.join(of, "set_key", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "class",
    )


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept: one row per document."""
    return _near_rows(docs, width, percent).drop("class")


def without_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with their columns."""
    return one_per_class(docs, _near_rows(docs, width, percent).where("class IS NOT NULL"), "near")


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), width=3, percent=85).drop("text_hash")
