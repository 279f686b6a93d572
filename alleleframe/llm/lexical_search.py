"""Ranked lexical search over a term-document grid held as K2-treaps.

Each input partition is cut into shards of a bounded number of postings. A shard
is a grid with a row per term and a column per document; its cells hold impacts,
the part of a score that depends on term and document alone. The grid is a
quadtree: every non-empty cell has a bit per non-empty quarter and the largest
impact in it, stored as the drop from the cell around it, so that both compress
well. Rows go by falling document frequency, which packs the frequent terms into
few cells; columns go by doc_id, which makes ties a matter of column order.

A search walks one shard with one item. The rows of all terms of the item are
followed down the quadtree together, over ranges of documents: the bound of a
range is the weighted sum of the impact maxima of the cells that hold (term,
range). Ranges are opened best first, some at a time, until no range left can
beat the k-th document found. Results of shards are exact, so the best of them
are the best of all.

Impacts need the number and the mean length of documents, so one pass counts
them first. Term weights need document frequencies; these are summed from the
dictionaries of the shards, for the terms of the items only. Items are packed in
blocks and meet every shard by an equality join on the block's number: the query
set is met by all shards, never documents by documents.

Nulls and special rows: a null or termless text has no terms, is no document for
the counts and is never found; an item without terms finds nothing. A null
``doc_id`` ranks after all others among equal scores; rows that repeat a doc_id
are documents of their own. Rows of items that repeat id and text are one item;
other rows with one id are ranked each for themselves under that id. Empty
tables give an empty result. A text may be of any length: it is one column,
read in pieces; other columns of both tables are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.llm.arrays import text_bytes
from alleleframe.llm.common import staged, table, whole_text

#: Postings and documents of a shard, at most, but for what one document has more.
POSTINGS = 3 << 18
DOCUMENTS = 1 << 14
#: Items of a block, about.
ITEMS = 256
#: Ranges opened together.
OPENED = 64
TOP = 10
#: Bytes of one text handled at a time, and terms counted at a time.
PIECE = 1 << 20
HELD = 1 << 20

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_BITS = np.array([bin(i).count("1") for i in range(16)], np.uint8)
#: Non-empty quarters before quarter q of a cell with a given mask.
_BEFORE = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int32)


def plain_bytes() -> bytes:
    """Translation of bytes: A-Z to lower case, all that ends a term to a space."""
    table = bytearray(range(256))
    for i in _SEPARATORS:
        table[i] = 32
    for i in range(65, 91):
        table[i] = i + 32
    return bytes(table)


def term_lists(data: bytes, plain: bytes):
    """Lists of the terms of one text, each from a piece of bounded size."""
    text = data.translate(plain)
    begin = 0
    while begin < len(text):
        end = len(text)
        if end - begin > PIECE:
            gap = text.find(b" ", begin + PIECE)
            end = gap if gap >= 0 else end
        yield text[begin:end].split()
        begin = end


def texts_of(column) -> tuple[bytes, list[int]]:
    """Bytes of all texts of a column, and their offsets."""
    data, offsets = text_bytes(column)
    return data.tobytes(), offsets.tolist()


def term_totals(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and terms of all documents."""
    plain = plain_bytes()

    def count(batches):
        documents = terms = 0
        for batch in batches:
            data, marks = texts_of(batch.column("text"))
            for a, b in zip(marks[:-1], marks[1:], strict=True):
                n = sum(map(len, term_lists(data[a:b], plain)))
                documents += n > 0
                terms += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([documents], pa.int64()), pa.array([terms], pa.int64())], names=["documents", "terms"]
        )

    parts = docs.select(whole_text().alias("text")).mapInArrow(count, "documents long, terms long")
    found = parts.agg(F.sum("documents"), F.sum("terms")).first()
    return found[0] or 0, found[1] or 0


class Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


def _spread(values: np.ndarray) -> np.ndarray:
    """Bits of 32-bit values moved to the even places."""
    x = values.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


def _squeezed(values: np.ndarray) -> bytes:
    """Compressed bytes of numbers, equal bytes of all numbers together."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.Codec("zstd", compression_level=3).compress(planes.tobytes(), asbytes=True)


def _released(data: bytes, count: int, kind) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    raw = pa.decompress(data, count * wide, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(wide, count).T).view(kind).reshape(count)


def pack_tree(row: np.ndarray, column: np.ndarray, impact: np.ndarray) -> dict:
    """height, n_cells, masks, drops: the quadtree of a grid with distinct places."""
    side = int(max(row.max(), column.max())) + 1
    height = max(1, (side - 1).bit_length())
    code = _spread(row) << np.uint64(1) | _spread(column)
    order = np.argsort(code)
    code, values = code[order], impact[order].astype(np.uint32)
    masks, drops = [], []
    for _ in range(height):
        above = code >> np.uint64(2)
        first = np.flatnonzero(np.append(True, above[1:] != above[:-1]))
        quarter = np.left_shift(np.uint8(1), (code & np.uint64(3)).astype(np.uint8))
        largest = np.maximum.reduceat(values, first)
        masks.append(np.bitwise_or.reduceat(quarter, first))
        drops.append(np.repeat(largest, np.diff(np.append(first, len(code)))) - values)
        code, values = above[first], largest
    drops = np.concatenate([values, *drops[::-1]])
    return {
        "height": height,
        "n_cells": len(drops),
        "masks": _squeezed(np.concatenate(masks[::-1])),
        "drops": _squeezed(drops),
    }


class Tree:
    """A quadtree read back: per level the masks, the first quarters' numbers and the maxima.

    Each level ends with an empty cell, which the number -1 names.
    """

    def __init__(self, height: int, n_cells: int, n_leaves: int, masks: bytes, drops: bytes):
        masks = _released(masks, n_cells - n_leaves, np.uint8)
        drops = _released(drops, n_cells, np.uint32)
        self.height, self.levels = height, []
        largest, cell, at = drops[:1], 0, 1
        for _ in range(height):
            mask = masks[cell : cell + len(largest)]
            cell += len(largest)
            many = _BITS[mask]
            ends = np.cumsum(many, dtype=np.int32)
            below = np.repeat(largest, many) - drops[at : at + int(ends[-1])]
            at += int(ends[-1])
            self.levels.append((np.append(mask, np.uint8(0)), np.append(ends - many, 0).astype(np.int32), np.append(below, np.uint32(0))))
            largest = below

    def opened(self, level: int, cells: np.ndarray, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Cells and their maxima in the left and in the right half of each range, per term."""
        masks, first, below = self.levels[level]
        down = (rows >> (self.height - 1 - level) & 1) * 2
        mask, base = masks[cells], first[cells]
        halves = []
        for half in (0, 1):
            quarter = down + half
            child = np.where(mask >> quarter & 1, base + _BEFORE[mask, quarter], -1)
            halves.append((child, below[child]))
        return halves


def best_of_tree(tree: Tree, rows: np.ndarray, weights: np.ndarray, top: int) -> list[tuple[int, int]]:
    """(score, column) of the best columns with a score above 0, by falling score, then column."""
    found: list[tuple[int, int]] = []  # a heap of (score, -column), worst first
    start = np.zeros((1, len(rows)), np.int32)
    waiting = [(-np.iinfo(np.int64).max, 0, 0, 0, np.array([np.iinfo(np.int64).max]), np.zeros(1, np.int64), start)]
    made = 1
    while waiting:
        _, _, _, level, bounds, ranges, cells = heapq.heappop(waiting)
        if len(found) == top:
            # A range with the bound of the last one found counts only if it begins before it.
            width = tree.height - level
            good = (bounds > found[0][0]) | (bounds == found[0][0]) & (ranges << width < -found[0][1])
            if not good[0] and bounds[0] < found[0][0]:
                break
            bounds, ranges, cells = bounds[good], ranges[good], cells[good]
            if not len(bounds):
                continue
        if len(bounds) > OPENED:
            rest = (bounds[OPENED:], ranges[OPENED:], cells[OPENED:])
            heapq.heappush(waiting, (-int(rest[0][0]), int(rest[1][0]), made, level, *rest))
            made += 1
        ranges, cells = ranges[:OPENED], cells[:OPENED]
        (left, of_left), (right, of_right) = tree.opened(level, cells, rows)
        bounds = np.concatenate([of_left.astype(np.int64) @ weights, of_right.astype(np.int64) @ weights])
        ranges = np.concatenate([2 * ranges, 2 * ranges + 1])
        cells = np.concatenate([left, right])
        order = np.lexsort((ranges, -bounds))
        order = order[: int((bounds > 0).sum())]
        bounds, ranges = bounds[order], ranges[order]
        if level + 1 == tree.height:
            for score, column in zip(bounds.tolist(), ranges.tolist(), strict=True):
                if len(found) < top:
                    heapq.heappush(found, (score, -column))
                elif (score, -column) > found[0]:
                    heapq.heapreplace(found, (score, -column))
                else:
                    break
        elif len(bounds):
            heapq.heappush(waiting, (-int(bounds[0]), int(ranges[0]), made, level + 1, bounds, ranges, cells[order]))
            made += 1
    return [(score, -column) for score, column in sorted(found, reverse=True)]


class _Shard:
    """Postings read since the last flush."""

    def __init__(self):
        self.numbers = Numbers()
        self.ids: list = []
        self.sizes: list[int] = []
        self.fresh: list[np.ndarray] = []
        self.owners: list[int] = []
        self.held = 0
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.postings = 0

    def add(self, doc_id, lists) -> None:
        get, size = self.numbers.__getitem__, 0
        place = len(self.ids)
        for terms in lists:
            if terms:
                self.fresh.append(np.fromiter(map(get, terms), np.int64, len(terms)))
                self.owners.append(place)
                size += len(terms)
                self.held += len(terms)
                if self.held >= HELD:
                    self.count()
        if size:
            self.ids.append(doc_id)
            self.sizes.append(size)
            if self.held >= HELD:
                self.count()

    def count(self) -> None:
        """Fold the terms held into (document, term) counts."""
        if self.fresh:
            owner = np.repeat(np.array(self.owners, np.int64), [len(x) for x in self.fresh])
            keys, counts = np.unique(owner << 32 | np.concatenate(self.fresh), return_counts=True)
            self.keys.append(keys)
            self.counts.append(counts)
            self.postings += len(keys)
            self.fresh, self.owners, self.held = [], [], 0

    def row(self, shard: int, documents: int, terms: int) -> dict:
        """The packed shard; ``documents`` and ``terms`` are those of the whole table."""
        self.count()
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        # A document whose pieces were counted apart has some keys twice.
        keys, where = np.unique(keys, return_inverse=True)
        tf = np.bincount(where, counts).astype(np.int64)
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] if self.ids[i] is not None else 0, i))
        column_of = np.empty(len(order), np.int64)
        column_of[order] = np.arange(len(order))
        document, term = keys >> 32, keys & 0xFFFFFFFF
        df = np.bincount(term, minlength=len(self.numbers))
        by_df = np.argsort(-df, kind="stable")
        row_of = np.empty(len(by_df), np.int64)
        row_of[by_df] = np.arange(len(by_df))
        m = 10 + (90 * np.array(self.sizes, np.int64) * documents) // terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[document])
        packed = pack_tree(row_of[term], column_of[document], impact)
        names = list(self.numbers)
        return {
            "shard": shard,
            "doc_ids": [self.ids[i] for i in order],
            "terms": [names[i] for i in by_df.tolist()],
            "df": df[by_df].tolist(),
            "n_leaves": len(keys),
            **packed,
        }


def _index_schema(docs: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
            T.StructField("terms", T.ArrayType(T.BinaryType())),
            T.StructField("df", T.ArrayType(T.LongType())),
            T.StructField("n_leaves", T.LongType()),
            T.StructField("height", T.IntegerType()),
            T.StructField("n_cells", T.LongType()),
            T.StructField("masks", T.BinaryType()),
            T.StructField("drops", T.BinaryType()),
        ]
    )


def index(docs: DataFrame, documents: int, terms: int, postings: int = POSTINGS) -> DataFrame:
    """One row per shard; every document with a term is in one. No shuffle."""
    schema = _index_schema(docs)
    plain = plain_bytes()

    def read(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        task, done, shard = TaskContext.get().partitionId(), 0, _Shard()

        def flushed():
            row = shard.row(task << 32 | done, documents, terms)
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            data, marks = texts_of(batch.column("text"))
            ids = batch.column("doc_id")
            for i, (a, b) in enumerate(zip(marks[:-1], marks[1:], strict=True)):
                shard.add(ids[i].as_py(), term_lists(data[a:b], plain))
                if shard.postings + shard.held >= postings or len(shard.ids) >= DOCUMENTS:
                    yield flushed()
                    done, shard = done + 1, _Shard()
        if shard.ids:
            yield flushed()

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(read, schema)


def item_terms(items: DataFrame) -> DataFrame:
    """item (a name for id and text), item_id, term: the distinct terms of every item."""
    plain = plain_bytes()
    named = items.select(
        F.md5(F.to_json(F.struct("item_id", "text"))).alias("item"), "item_id", whole_text().alias("text")
    ).dropDuplicates(["item"])
    schema = T.StructType(
        [
            T.StructField("item", T.StringType()),
            T.StructField("item_id", items.schema["item_id"].dataType),
            T.StructField("terms", T.ArrayType(T.BinaryType())),
        ]
    )

    def read(batches):
        for batch in batches:
            data, marks = texts_of(batch.column("text"))
            found = [
                sorted({t for some in term_lists(data[a:b], plain) for t in some})
                for a, b in zip(marks[:-1], marks[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))],
                names=schema.names,
            )

    return named.mapInArrow(read, schema).select("item", "item_id", F.explode("terms").alias("term"))


def weighted_items(items: DataFrame, shards: DataFrame, documents: int) -> DataFrame:
    """item, item_id, terms, weights: the terms that some document has, with weights above 0."""
    wanted = staged(item_terms(items), "search-terms")
    df = (
        shards.select(F.explode(F.arrays_zip("terms", "df")).alias("t"))
        .select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
        .join(wanted.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("df").alias("df"))
    )
    weight = F.floor(1000 * F.log((2 * F.lit(float(documents)) + 2) / (2 * F.col("df") + 1))).cast("long")
    return (
        wanted.join(df.select("term", weight.alias("weight")), "term")
        .where("weight > 0")
        .groupBy("item")
        .agg(
            F.first("item_id").alias("item_id"),
            F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("found"),
        )
        .select("item", "item_id", F.col("found.term").alias("terms"), F.col("found.weight").alias("weights"))
    )


def search(docs: DataFrame, items: DataFrame, top: int = TOP, postings: int = POSTINGS) -> DataFrame:
    """item, item_id, rank, doc_id, score: the ``top`` best documents of every item."""
    documents, terms = term_totals(docs)
    shards = staged(index(docs, documents, terms, postings), "search-index")
    weighted = staged(weighted_items(items, shards, documents), "search-items")
    n_blocks = max(1, -(-weighted.count() // ITEMS))
    blocks = (
        weighted.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int"))
        .groupBy("block")
        .agg(F.collect_list(F.struct("item", "item_id", F.col("terms").alias("item_terms"), "weights")).alias("items"))
    )
    asked = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    asked = asked.drop("df").join(blocks, "block")
    schema = T.StructType(
        [
            T.StructField("item", T.StringType()),
            T.StructField("item_id", items.schema["item_id"].dataType),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("score", T.LongType()),
        ]
    )

    def walk(group: pa.Table) -> pa.Table:
        row = {n: group.column(n)[0] for n in ("height", "n_cells", "n_leaves", "masks", "drops")}
        tree = Tree(*(row[n].as_py() for n in row))
        numbers = {t: i for i, t in enumerate(group.column("terms")[0].as_py())}
        ids = group.column("doc_ids")[0].values
        columns: list[list] = [[], [], []]
        places: list[int] = []
        for item in group.column("items")[0].as_py():
            pairs = [(numbers[t], w) for t, w in zip(item["item_terms"], item["weights"], strict=True) if t in numbers]
            if not pairs:
                continue
            rows, weights = np.array(pairs, np.int64).T
            for score, place in best_of_tree(tree, rows, weights, top):
                places.append(place)
                for column, value in zip(columns, (item["item"], item["item_id"], score), strict=True):
                    column.append(value)
        return pa.table(
            [
                pa.array(columns[0], pa.string()),
                pa.array(columns[1], group.schema.field("items").type.value_type.field("item_id").type),
                ids.take(pa.array(places, pa.int64())),
                pa.array(columns[2], pa.int64()),
            ],
            names=schema.names,
        )

    found = asked.groupBy("shard", "block").applyInArrow(walk, schema)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item", "item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


SQL = {
    "op11_lexical_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(COALESCE(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
dl AS (SELECT r, doc_id, terms, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
g AS (SELECT COUNT(*)::BIGINT AS nn, SUM(n)::BIGINT AS ll FROM dl),
tf AS (SELECT r, term, COUNT(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM dl) GROUP BY ALL),
df AS (SELECT term, COUNT(*)::BIGINT AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, g),
q AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(COALESCE(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT q.item_id, q.text, dl.r, dl.doc_id,
  SUM(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * dl.n * g.nn) // g.ll))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN dl USING (r), g GROUP BY ALL),
p AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id, text
  ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM p WHERE rank <= 10
""",
}
