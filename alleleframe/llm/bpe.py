"""Byte-level BPE over whole corpora: every distinct word is encoded once.

Pre-tokens (the matches of the public pattern) repeat a lot. Documents are read
in blocks of a bounded number of pre-tokens. A block keeps the sequence of its
pre-tokens by position, as numbers of the block's own word list, and hands out
that word list once, packed into one row per hash bucket of words. Buckets are
the global distinct-word shuffle: all lists of a bucket meet, each distinct word
is encoded once, and every list gets its ids back as one packed row. Blocks are
then put together again by position. A frequent word is one entry per block, and
apart from the sequences only words that differ within a block are moved.

Decoding joins the token-byte table: 50,256 rows whatever the data, so it is
sent to the executors whole.

Nulls: a null text is empty and has no tokens; ``doc_id`` is only carried along,
also null or repeated. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.llm.arrays import spans, text_bytes
from alleleframe.llm.common import staged, table, whole_text

#: Pre-tokens of a block, at most, but for what one megabyte of text or one document has more.
BLOCK = 3 << 20
#: Bytes of text per bucket of words.
PER_BUCKET = 1 << 24
MOST_BUCKETS = 1 << 18
#: Pre-tokens of a block whose ids are put together at a time, but for what one document has more.
SLICE = 1 << 18
#: Numbers up to here take one byte, two bytes, more.
_ONE, _TWO = 1 << 7, 1 << 14
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def character_kinds() -> np.ndarray:
    r"""Kind of every code point, as the tokenizer's own pattern engine sees \p{L}, \p{N} and \s."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    kinds = np.full(0x110000, _OTHER, np.uint8)
    bytes_only = {bytes([i]): i for i in range(256)}
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        tool = tiktoken.Encoding(
            "kind", pat_str=pattern, mergeable_ranks=bytes_only, special_tokens={}
        )
        matched = bytes(tool.encode_ordinary("".join(points))).decode()
        kinds[np.frombuffer(matched.encode("utf-32-le"), np.uint32)] = kind
    return kinds


def token_starts(points: np.ndarray, fresh: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the matches of the public pattern begin; ``fresh`` marks the first point of a text.

    Matches cover the whole text, so their starts are enough. They are runs of
    one kind, with a space before them if there is one. White space before
    something else leaves its last character to what follows. An apostrophe that
    begins a match takes one of seven endings with it.
    """
    n = len(points)
    kind = kinds[points]
    begins = fresh.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    after_blank = np.zeros(n, bool)
    after_blank[1:] = (points[:-1] == 32) & ~fresh[1:]
    starts = begins & (space | ~after_blank)
    ends_run = np.zeros(n, bool)
    ends_run[:-1] = space[:-1] & ~space[1:] & ~fresh[1:]
    starts |= ends_run
    quote = np.flatnonzero(starts & (points == 39))
    if len(quote):
        padded = np.append(points, [0, 0, 0])
        new = np.append(fresh, [True, True, True])
        one = np.where(new[quote + 1], 0, padded[quote + 1])
        two = np.where(new[quote + 1] | new[quote + 2], 0, padded[quote + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        taken = quote[short | long]
        starts[taken + 1] = False
        after = np.concatenate([quote[short] + 2, quote[long] + 3])
        starts[quote[long] + 2] = False
        starts[after[after < n]] = True
    return np.flatnonzero(starts)


def pack(values: np.ndarray) -> np.ndarray:
    """Seven bits a byte, low ones first, the last byte of a value below 128."""
    sizes = 1 + (values >= 1 << 7) + (values >= 1 << 14) + (values >= 1 << 21)
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    first = ends - sizes
    for k in range(4):
        more = sizes > k
        out[first[more] + k] = (values[more] >> 7 * k & 127) | np.where(sizes[more] > k + 1, 128, 0)
    return out


def unpack(data: np.ndarray) -> np.ndarray:
    """The values of ``pack``."""
    last = np.flatnonzero(data < 128)
    found = np.empty(len(last), np.uint32)
    for i in range(0, len(last), 1 << 18):
        ends = last[i : i + (1 << 18)]
        begin = int(last[i - 1]) + 1 if i else 0
        part = data[begin : int(ends[-1]) + 1]
        first = np.append(0, ends[:-1] + 1 - begin)
        place = np.arange(len(part)) - np.repeat(first, np.diff(np.append(first, len(part))))
        found[i : i + len(ends)] = np.add.reduceat((part & 127).astype(np.int64) << 7 * place, first)
    return found


def _squeezed(values) -> bytes:
    """Compressed bytes, with their size before."""
    raw = values if isinstance(values, bytes) else values.tobytes()
    squeeze = pa.Codec("zstd", compression_level=9)
    return len(raw).to_bytes(8, "little") + squeeze.compress(raw, asbytes=True)


def _released(data: bytes, kind=np.uint8) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), kind)


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        return number


class _Block:
    """Word numbers of the documents read since the last flush."""

    def __init__(self, kinds: np.ndarray):
        self.kinds = kinds
        self.number = _Numbers()
        self.ids: list = []
        self.parts: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.size = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, ids: pa.Array) -> None:
        """Take some whole documents."""
        first_byte = np.flatnonzero((data & 0xC0) != 0x80)
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        begin = np.searchsorted(first_byte, offsets[:-1])
        fresh = np.zeros(len(points), bool)
        fresh[begin[offsets[:-1] < offsets[1:]]] = True
        starts = token_starts(points, fresh, self.kinds) if len(points) else np.zeros(0, np.int64)
        byte_at = np.append(first_byte, len(data))
        cuts = byte_at[np.append(starts, len(points))].tolist() if len(starts) else [0]
        words = [raw[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        # Words are numbered by their bytes: equal numbers are equal words.
        self.parts.append(np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words)))
        # Empty documents share their place with the next one and come before it.
        row = np.searchsorted(begin, starts, "right") - 1
        self.lengths.append(np.bincount(row, minlength=len(begin)))
        self.ids.append(ids)
        self.size += len(words)

    def rows(self, name: str, n_buckets: int) -> pa.RecordBatch:
        """One row with the documents and their sequence, and one row of words per bucket.

        Words are listed by bucket and bytes. Their numbers go by kind first (the
        128 most frequent, the next 16,256, the rest), then by place in that list,
        so frequent words are short in a sequence and the list needs no numbers.
        """
        numbers = np.concatenate(self.parts)
        known = list(self.number)
        counts = np.bincount(numbers, minlength=len(known))
        order = np.argsort(-counts, kind="stable")
        kind = np.empty(len(order), np.uint8)
        kind[order] = (np.arange(len(order)) >= _ONE) + (np.arange(len(order)) >= _TWO).astype(int)
        bucket = np.fromiter(map(zlib.crc32, known), np.int64, len(order)) % n_buckets
        listed = sorted(zip(bucket.tolist(), known, range(len(order)), strict=True))
        where = np.fromiter((i for _, _, i in listed), np.int64, len(listed))
        place = np.empty(len(order), np.uint32)
        place[where[np.argsort(kind[where], kind="stable")]] = np.arange(len(order))
        packed = [pack(place[numbers[i : i + (1 << 18)]]) for i in range(0, len(numbers), 1 << 18)]
        head = np.concatenate(self.lengths).astype("<u4")
        ids = pa.concat_arrays(self.ids)
        first = np.flatnonzero(np.diff(np.append(-1, bucket[where])))
        words, kinds = [], []
        for a, b in zip(first, np.append(first[1:], len(where))[: len(first)], strict=True):
            some = [w for _, w, _ in listed[a:b]]
            sizes = pack(np.fromiter(map(len, some), np.int64, len(some)))
            words.append(_squeezed(len(some).to_bytes(8, "little") + sizes.tobytes() + b"".join(some)))
            kinds.append(_squeezed(kind[where[a:b]]))
        n = len(first)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name] * (n + 1)),
                pa.array([-1, *bucket[where[first]].tolist()], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)] + [len(ids)] * n, pa.int32()), ids),
                pa.array([_squeezed(head)] + kinds, pa.binary()),
                pa.array([_squeezed(b"".join(p.tobytes() for p in packed))] + words, pa.binary()),
            ],
            names=["block", "bucket", "doc_ids", "head", "data"],
        )


def blocks(docs: DataFrame, n_buckets: int, block_size: int = BLOCK) -> DataFrame:
    """block, bucket, doc_ids, head, data: documents (bucket -1) and words of every block."""
    schema = T.StructType(
        [
            T.StructField("block", T.StringType()),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
            T.StructField("head", T.BinaryType()),
            T.StructField("data", T.BinaryType()),
        ]
    )
    kinds = docs.sparkSession.sparkContext.broadcast(character_kinds())

    def read(batches):
        task = TaskContext.get().partitionId()
        done, block = 0, _Block(kinds.value)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in spans(offsets):
                block.add(
                    data[offsets[first] : offsets[last]],
                    offsets[first : last + 1] - offsets[first],
                    batch.column("doc_id").slice(first, last - first),
                )
                if block.size >= block_size:
                    yield block.rows(f"{task}-{done}", n_buckets)
                    done, block = done + 1, _Block(kinds.value)
        if block.ids:
            yield block.rows(f"{task}-{done}", n_buckets)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(read, schema)


def _encoded_list(data: bytes, known: dict[bytes, bytes], tool: tiktoken.Encoding) -> bytes:
    """A packed word list with ids in place of words; ``known`` has the ids of words met before."""
    raw = _released(data).tobytes()
    n = int.from_bytes(raw[:8], "little")
    # Sizes come before the words; each ends with a byte below 128.
    small = np.flatnonzero(np.frombuffer(raw, np.uint8, offset=8) < 128)
    end = int(small[n - 1]) + 1
    sizes = unpack(np.frombuffer(raw, np.uint8, end, 8)).astype(np.int64)
    ids, at = [], 8 + end
    for stop in (at + np.cumsum(sizes)).tolist():
        word = raw[at:stop]
        at = stop
        if word not in known:
            known[word] = np.array(tool.encode_ordinary(word.decode()), "<u4").tobytes()
        ids.append(known[word])
    counts = pack(np.fromiter(map(len, ids), np.int64, n) // 4).tobytes()
    flat = np.frombuffer(b"".join(ids), "<u4")
    # Low and high halves apart: most ids are below 2^16, so one half is nearly all zero.
    halves = (flat & 0xFFFF).astype("<u2").tobytes() + (flat >> 16).astype("<u2").tobytes()
    return _squeezed(len(counts).to_bytes(8, "little") + counts + halves)


def encoded_words(lists: DataFrame, ranks_path: str) -> DataFrame:
    """The word lists of blocks with ids in place of words: each distinct word is encoded once."""
    ranks = lists.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    pattern = public_tokenizers.PATTERN

    made: list[tiktoken.Encoding] = []

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:  # once per task, not per bucket
            made.append(
                tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
            )
        known: dict[bytes, bytes] = {}
        for batch in batches:
            for i, data in enumerate(batch.column("data")):
                packed = _encoded_list(data.as_py(), known, made[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(i, 1) for c in ("block", "bucket", "head")),
                        pa.array([packed], pa.binary()),
                    ],
                    names=["block", "bucket", "head", "data"],
                )

    return lists.groupBy("bucket").applyInArrow(
        encode, "block string, bucket int, head binary, data binary"
    )


def _ids_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids per word and all ids of one packed list."""
    raw = _released(data).tobytes()
    size = int.from_bytes(raw[:8], "little")
    counts = unpack(np.frombuffer(raw, np.uint8, size, 8)).astype(np.int32)
    total = int(counts.sum())
    low, high = np.frombuffer(raw, "<u2", 2 * total, 8 + size).astype(np.int32).reshape(2, total)
    return counts, low | high << 16


def _assembled(
    docs: DataFrame, ranks_path: str, block_size: int, finish, schema: T.StructType
) -> DataFrame:
    """What ``finish(doc_ids, ids, ends)`` makes of every block: its ids, cut at ``ends`` into documents."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(whole_text()))).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = min(MOST_BUCKETS, max(tasks, -(-size // PER_BUCKET)))
    parts = staged(blocks(docs, n_buckets, block_size), "bpe-blocks")
    words = encoded_words(parts.where("bucket >= 0").select("block", "bucket", "head", "data"), ranks_path)
    rows = parts.where("bucket < 0").unionByName(
        words.withColumn("doc_ids", F.lit(None).cast(parts.schema["doc_ids"].dataType))
    )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The documents first, then the lists in order: packed, a few MB in all.
        group = pa.Table.from_batches(list(batches)).sort_by("bucket")
        heads, lists = group.column("head").to_pylist(), group.column("data").to_pylist()
        ends = np.append(0, np.cumsum(_released(heads[0], "<u4"), dtype=np.int64))
        numbers = unpack(_released(lists[0]))
        doc_ids = group.column("doc_ids")[0].values
        if len(lists) == 1:  # all documents are empty
            flat, starts, sizes = (np.zeros(0, np.int32) for _ in range(3))
        else:
            kind = np.concatenate([_released(h) for h in heads[1:]])
            found = [_ids_of(x) for x in lists[1:]]
            sizes = np.concatenate([c for c, _ in found])
            flat = np.concatenate([f for _, f in found])
            starts = np.cumsum(sizes, dtype=np.int32) - sizes
            by_number = np.argsort(kind, kind="stable")
            sizes, starts = sizes[by_number], starts[by_number]
        del group, lists
        # Some documents at a time, so that the ids of a block are never all held.
        for a, b in spans(ends, SLICE):
            pieces, totals = [], [np.zeros(1, np.int64)]
            for i in range(ends[a], ends[b], SLICE):
                some = numbers[i : min(i + SLICE, ends[b])]
                many = sizes[some]
                before = np.cumsum(many, dtype=np.int64)
                pieces.append(flat[np.arange(before[-1]) + np.repeat(starts[some] - (before - many), many)])
                totals.append(before + totals[-1][-1])
            ids = np.concatenate(pieces) if pieces else np.zeros(0, np.int32)
            token_ends = np.concatenate(totals)[ends[a : b + 1] - ends[a]]
            yield from finish(doc_ids.slice(a, b - a), ids, token_ends).combine_chunks().to_batches()

    return rows.groupBy("block").applyInArrow(assemble, schema)


def _with_ids(docs: DataFrame, *more: T.StructField) -> list[T.StructField]:
    return [
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        *more,
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]


def encode(docs: DataFrame, ranks_path: str, block_size: int = BLOCK) -> DataFrame:
    """doc_id, ids: the token ids of every whole text, one row per document."""

    def finish(doc_ids, ids, ends):
        values = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
        return pa.table([doc_ids, values], names=["doc_id", "ids"])

    return _assembled(docs, ranks_path, block_size, finish, T.StructType(_with_ids(docs)))


def token_bytes(ranks_path: str) -> dict[int, bytes]:
    """The token-byte table."""
    return {i: word for word, i in read_ranks(ranks_path).items()}


def decoded(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids, data: the bytes that the ids stand for, from the token-byte table."""
    tokens = encoded.sparkSession.sparkContext.broadcast(token_bytes(ranks_path))
    schema = T.StructType([*encoded.select("doc_id", "ids").schema, T.StructField("data", T.BinaryType())])

    def decode(batches):
        token = tokens.value
        for batch in batches:
            # One document at a time: as Python numbers, ids take ten times their room.
            data = [
                None if ids.values is None else b"".join([token[i] for i in ids.values.to_numpy().tolist()])
                for ids in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=schema.names
            )

    return encoded.select("doc_id", "ids").mapInArrow(decode, schema)


def round_trip(
    docs: DataFrame, ranks_path: str, with_ids: bool = False, block_size: int = BLOCK
) -> DataFrame:
    """Every text encoded, and its ids decoded again, with digests of both.

    doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256
    and, if asked for, ids. Ids are decoded where they are put together.
    """
    tokens = docs.sparkSession.sparkContext.broadcast(token_bytes(ranks_path))
    fields = _with_ids(
        docs,
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    )
    schema = T.StructType(fields if with_ids else fields[:-1])

    def finish(doc_ids, ids, ends):
        token = tokens.value
        of_ids, of_data = [], []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            digests = hashlib.sha256(), hashlib.sha256()
            for i in range(a, b, SLICE):
                some = ids[i : min(i + SLICE, b)].tolist()
                digests[0].update(((" " if i > a else "") + " ".join(map(str, some))).encode())
                digests[1].update(b"".join([token[t] for t in some]))
            of_ids.append(digests[0].hexdigest())
            of_data.append(digests[1].hexdigest())
        columns = [
            doc_ids,
            pa.array(np.diff(ends), pa.int64()),
            pa.array(of_ids, pa.string()),
            pa.array(of_data, pa.string()),
        ]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)))
        return pa.table(columns, names=schema.names)

    return _assembled(docs, ranks_path, block_size, finish, schema)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(table(spark, sf_dir, "documents"), path)
