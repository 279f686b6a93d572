"""Near-duplicate vectors by sorted projection passes.

Equal vectors form a class first; the rest works on classes. In every pass each
vector gets 64 random hyperplane bits as one key, and vectors are put in the
order of their keys, so that close vectors, which agree in most bits, tend to
be near each other. Ranks cut that order into blocks of ``BLOCK`` vectors; each
vector is compared with its own block and the two beside it: a bounded window.
Pairs are verified by cosine in double precision, and a block hands out, per
vector, one link that spans what it found. Passes are united by connected
components (large-star and small-star).

The number of passes follows from the number of vectors: evenly spread, about
``BLOCK`` of them share a prefix of ``prefix_bits`` bits, and a pair at the
threshold shares it with a known probability, whatever the other vectors are.
Passes are repeated until a pair shares it in none with less than ``MISS``.
Where more vectors share a prefix than windows span, as in a dense group, all
blocks of that prefix are compared with each other, spread over tasks. So each
pair that shares a prefix in any pass is compared, and the bound on misses holds
for every distribution; what a dense group costs is the square of its size.

Windows are bounded, groups of close vectors are not. So links are counted
afterwards, exactly, inside the components: all members are compared, in blocks
that spread over tasks, and only counts are handed out. Pairs are never listed.

Nulls: vectors that are null, empty, zero or have null or non-finite components
link with nothing, as do vectors of different lengths. A null ``vec_id`` takes
part, but is never the smallest of a component that has an id. Rows that repeat
a vector are copies, linked with each other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.llm.arrays import spanning, whole_groups
from alleleframe.llm.common import staged, table
from alleleframe.llm.components import components

THRESHOLD = 0.95
BLOCK = 1024
GROUP = 4  # blocks that travel together, so that vectors are sent fewer times
MISS = 1e-4
SEED = 11


def prefix_bits(rows: int) -> int:
    """Leading bits of the keys that about ``BLOCK`` evenly spread vectors share."""
    return max(0, math.ceil(math.log2(max(1, rows) / BLOCK)))


def passes_needed(rows: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Passes until a pair at ``threshold`` shares no prefix with less than ``miss``."""
    hit = (1 - math.acos(threshold) / math.pi) ** prefix_bits(rows)
    return 1 if hit >= 1 else max(1, math.ceil(math.log(miss) / math.log(1 - hit)))


def vector_rows(embeddings: DataFrame) -> DataFrame:
    """vec_id, node (128 bits that name the vector, null if it can't be linked), size, vector (doubles)."""
    schema = T.StructType(
        [
            T.StructField("vec_id", embeddings.schema["vec_id"].dataType),
            T.StructField("node", T.BinaryType()),
            T.StructField("size", T.IntegerType()),
            T.StructField("vector", T.BinaryType()),
        ]
    )

    def read(batches):
        for batch in batches:
            nodes, sizes, vectors = [], [], []
            for value in batch.column("embedding"):
                values = value.values
                if values is None or values.null_count or len(values) == 0:
                    raw = None
                else:
                    raw = values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # no -0.0
                    raw = raw if np.isfinite(raw).all() and raw.any() else None
                data = None if raw is None else raw.tobytes()
                vectors.append(data)
                sizes.append(None if raw is None else len(raw))
                nodes.append(None if raw is None else hashlib.blake2b(data, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(nodes, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(vectors, pa.binary()),
                ],
                names=schema.names,
            )

    return embeddings.select("vec_id", F.col("embedding").cast("array<double>")).mapInArrow(read, schema)


def _unit(vectors: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def sort_keys(classes: DataFrame, passes: int) -> DataFrame:
    """turn, size, key, node: the key of every class in every pass."""

    def read(batches):
        planes = {}
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                some = batch.filter(pa.array(sizes == size))
                if size not in planes:
                    planes[size] = np.random.default_rng([SEED, size]).standard_normal((size, 64 * passes))
                bits = _unit(some.column("vector").to_pylist()) @ planes[size] > 0
                keys = np.packbits(bits, axis=1).view(">u8").astype(np.uint64) ^ np.uint64(1 << 63)
                turns = np.tile(np.arange(passes, dtype=np.int32), some.num_rows)
                each = pa.array(np.repeat(np.arange(some.num_rows), passes))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(turns),
                        some.column("size").take(each),
                        pa.array(keys.reshape(-1).view(np.int64)),
                        some.column("node").take(each),
                    ],
                    names=["turn", "size", "key", "node"],
                )

    return classes.select("size", "vector", "node").mapInArrow(
        read, "turn int, size int, key bigint, node binary"
    )


def blocked(keys: DataFrame, bits: int) -> DataFrame:
    """turn, size, prefix, node, block: blocks of ``BLOCK`` rows in the order of the keys."""
    prefix = F.shiftright("key", 64 - bits) if bits else F.lit(0).cast("bigint")
    order = ["turn", "size", "key", "node"]
    ordered = staged(
        keys.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"place": F.monotonically_increasing_id(), "part": F.spark_partition_id()}),
        "vector-order",
    )
    # One row per partition of the order.
    parts = ordered.groupBy("part").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    before = F.sum("rows").over(W.orderBy("part")) - F.col("rows")
    parts = parts.select("part", (before - F.col("first")).alias("shift"))
    return ordered.join(parts, "part").select(
        "turn", "size", prefix.alias("prefix"), "node", F.floor((F.col("place") + F.col("shift")) / BLOCK).alias("block")
    )


def _linked(one: np.ndarray, other: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows reach ``threshold``; single precision decides what is not near it."""
    near = one.astype(np.float32) @ other.astype(np.float32).T
    found = near >= threshold
    close = np.abs(near - threshold) < 1e-4
    if close.any():
        a, b = np.nonzero(close)
        found[a, b] = np.einsum("ij,ij->i", one[a], other[b]) >= threshold
    return found


def _as_links(nodes: pa.Array, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    none = np.zeros(0, np.int64)
    one, other = (np.concatenate([none, *[f[i] for f in found]]) for i in (0, 1))
    return pa.table([nodes.take(pa.array(one)), nodes.take(pa.array(other))], names=["node", "other"])


def window_links(placed: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """node, other: links that span what the windows hold."""
    # The first block of a group is also the one beside the last block of the group before.
    group_of = F.floor(F.col("block") / GROUP)
    groups = F.when(F.col("block") % GROUP == 0, F.array(group_of, group_of - 1)).otherwise(F.array(group_of))
    rows = placed.join(classes.select("node", "vector"), "node").withColumn("at", F.explode(groups))

    def compare(group: pa.Table) -> pa.Table:
        at = group.column("at")[0].as_py()
        turn, size, block = (group.column(c).to_numpy() for c in ("turn", "size", "block"))
        vectors = group.column("vector").to_pylist()
        found = []
        for t, s in sorted(set(zip(turn.tolist(), size.tolist(), strict=True))):
            rows = np.flatnonzero((turn == t) & (size == s))
            rows = rows[np.argsort(block[rows], kind="stable")]
            unit = _unit([vectors[i] for i in rows.tolist()])
            for home in range(at * GROUP, (at + 1) * GROUP):
                start, end, after = np.searchsorted(block[rows], [home, home + 1, home + 2])
                if end == start or after - start < 2:
                    continue
                linked = _linked(unit[start:end], unit[start:after], threshold)
                apart, to = spanning(linked, np.arange(start, end), np.arange(start, after))
                found.append((rows[apart], rows[to]))
        return _as_links(group.column("node").combine_chunks(), found)

    return rows.groupBy("at").applyInArrow(compare, "node binary, other binary").distinct()


def prefix_links(placed: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """node, other: links that span each prefix which reaches further than the windows."""
    prefix = ["turn", "size", "prefix"]
    long = (
        placed.groupBy(*prefix)
        .agg(F.min("block").alias("first"), F.max("block").alias("last"))
        .where(F.col("last") - F.col("first") > 1)
        .withColumn("tiles", F.floor((F.col("last") - F.col("first")) / GROUP) + 1)
    )
    rows = (
        placed.join(long, prefix)
        .withColumn("tile", F.floor((F.col("block") - F.col("first")) / GROUP))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
        .withColumns({"low": F.least("tile", "with"), "high": F.greatest("tile", "with")})
        .select(*prefix, "low", "high", "tile", "node")
        .join(classes.select("node", "vector"), "node")
    )

    def compare(group: pa.Table) -> pa.Table:
        tile = group.column("tile").to_numpy()
        low, high = (group.column(c)[0].as_py() for c in ("low", "high"))
        unit = _unit(group.column("vector").to_pylist())
        one, other = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        found = []
        for a in range(0, len(one), BLOCK):
            for b in range(a if low == high else 0, len(other), BLOCK):
                some, rest = one[a : a + BLOCK], other[b : b + BLOCK]
                found.append(spanning(_linked(unit[some], unit[rest], threshold), some, rest))
        return _as_links(group.column("node").combine_chunks(), found)

    found = rows.groupBy(*prefix, "low", "high").applyInArrow(compare, "node binary, other binary")
    return found.distinct()


def link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """node, links: rows linked with each class; ``members`` has component, node, size, copies, vector."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / (GROUP * BLOCK)).cast("int").alias("blocks"))
    at = ["part", "low", "high"]
    placed = (
        members.join(sizes, "component")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "with"), "high": F.greatest("block", "with")})
        .select(F.xxhash64("component").alias("part"), "low", "high", "block", "node", "size", "copies", "vector")
    )

    def count(batches):
        for rows, first in whole_groups(batches, at):
            low, high, block, size, copies = (
                rows.column(c).to_numpy() for c in ("low", "high", "block", "size", "copies")
            )
            vectors = rows.column("vector").to_pylist()
            found = np.zeros(rows.num_rows, np.int64)
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                for s in np.unique(size[a:b]).tolist():
                    some = a + np.flatnonzero(size[a:b] == s)
                    one, other = some[block[some] == low[a]], some[block[some] == high[a]]
                    if len(one) == 0 or len(other) == 0:
                        continue
                    first_unit = _unit([vectors[i] for i in one.tolist()])
                    unit = _unit([vectors[i] for i in other.tolist()])
                    for start in range(0, len(one), BLOCK):
                        part = one[start : start + BLOCK]
                        linked = _linked(first_unit[start : start + BLOCK], unit, threshold)
                        if low[a] == high[a]:
                            linked[np.arange(len(part)), np.arange(start, start + len(part))] = False
                        else:
                            found[other] += copies[part] @ linked
                        found[part] += linked @ copies[other]
            yield pa.RecordBatch.from_arrays(
                [rows.column("node").combine_chunks(), pa.array(found)], names=["node", "links"]
            )

    counted = placed.repartition(*at).sortWithinPartitions(*at).mapInArrow(
        count, "node binary, links bigint"
    )
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    rows = staged(vector_rows(embeddings), "vector-rows")
    classes = (
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("vec_id").alias("least_id"),
            F.count("*").alias("copies"),
            F.any_value("size").alias("size"),
            F.any_value("vector").alias("vector"),
        )
    )
    classes = staged(classes, "vector-classes")
    n = classes.count()
    placed = staged(blocked(sort_keys(classes, passes_needed(n, threshold)), prefix_bits(n)), "vector-blocks")
    links = window_links(placed, classes, threshold).unionByName(prefix_links(placed, classes, threshold))
    found = components(links)
    counts = link_counts(classes.join(found, "node"), threshold)
    of = (
        classes.select("node", "least_id", "copies")
        .join(found, "node", "left")
        .join(counts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    named = of.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of = of.join(named, "component").select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", "node").join(of, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
