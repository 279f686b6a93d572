"""Text lines of block-gzip files, split over tasks, and the leading lines of many files in one job.

A block-gzip file (``.bgz``, and most ``.vcf.gz``) is a row of gzip members of at
most 64 KB, each with its compressed size in its header. A task gets a range of
bytes, finds the first member that begins in it and reads member by member, so
one file of any size gives as many tasks as it has ranges. A line belongs to the
range it begins in, as in Spark's own text source: all ranges but a file's first
leave out what comes before their first line end, and each reads on until the
line that begins at or before its end is complete.

Files are opened by ``pyarrow.fs``, which knows local paths and the usual object
stores; Spark lists them, so patterns and folders work as everywhere.
"""

from __future__ import annotations

import json
import struct
import sys
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Readers travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_BYTES = 64 * 1024 * 1024
#: Bytes of lines handed to Spark at a time.
_BATCH_BYTES = 4 * 1024 * 1024
#: Files whose leading lines one task reads.
FILES_PER_TASK = 16
# How a member of a block-gzip file begins, its fixed part, and the largest member.
_MAGIC = b"\x1f\x8b\x08\x04"
_FIXED = 12
_LARGEST = 1 << 16


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a file as Spark names it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def member_size(head: bytes) -> int:
    """Compressed size of the member whose bytes ``head`` begins with; 0 if it is none."""
    if len(head) < _FIXED or not head.startswith(_MAGIC):
        return 0
    extra = struct.unpack_from("<H", head, 10)[0]
    at, end = _FIXED, _FIXED + extra
    while at + 4 <= min(end, len(head)):
        kind, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if kind == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return 0


def first_member(file: BinaryIO, start: int, end: int, size: int) -> int:
    """Offset of the first member that begins in [start, end), or -1.

    Compressed bytes may look like a header by chance, so a member counts only if
    another one, or the end of the file, follows it, and it inflates.
    """
    file.seek(start)
    # A member that begins in the range lies within the largest size after it, and so does the next header.
    data = file.read(min(end - start + 2 * _LARGEST, 4 * _LARGEST))
    at = data.find(_MAGIC)
    while at >= 0 and start + at < end:
        length = member_size(data[at : at + 64])
        follows = at + length
        whole = length and (start + follows == size or member_size(data[follows : follows + 64]))
        if whole:
            try:
                inflated(data[at:follows])
                return start + at
            except zlib.error:
                pass
        at = data.find(_MAGIC, at + 1)
    return -1


def inflated(member: bytes) -> bytes:
    """Bytes of one member; its checksum is verified."""
    tool = zlib.decompressobj(31)
    found = tool.decompress(member) + tool.flush()
    if not tool.eof:
        raise zlib.error("a member is cut off")
    return found


def members(file: BinaryIO, at: int) -> Iterator[tuple[int, bytes]]:
    """Offsets and bytes of the members from ``at`` on."""
    file.seek(at)
    held, used = b"", 0
    while True:
        if len(held) - used < _LARGEST:
            held, used = held[used:] + file.read(16 * _LARGEST), 0
        if used == len(held):
            return
        length = member_size(held[used : used + 64])
        if not length or length > len(held) - used:
            raise ValueError(f"no whole block-gzip member at byte {at}")
        yield at, inflated(held[used : used + length])
        at, used = at + length, used + length


def lines_of_range(file: BinaryIO, start: int, end: int, size: int) -> Iterator[list[bytes]]:
    """Lists of the lines that belong to a range of bytes."""
    at = 0 if start == 0 else first_member(file, start, end, size)
    if at < 0:
        return
    rest: list[bytes] = []  # what the present line has so far
    inside = start == 0  # whether the present line is one of this range
    for offset, data in members(file, at):
        late = offset >= end
        if late and not inside:
            return
        parts = data.split(b"\n")
        if late:
            # The line that was open, or begins here, is the last one.
            rest.append(parts[0])
            if len(parts) > 1:
                yield [b"".join(rest)]
                return
            continue
        if not inside:
            if len(parts) == 1:
                continue
            inside, parts = True, parts[1:]
        if len(parts) > 1:
            yield [b"".join([*rest, parts[0]]), *parts[1:-1]]
            rest = [parts[-1]]
        else:
            rest.append(parts[0])
    last = b"".join(rest)
    if inside and last:
        yield [last]


@dataclass
class _Range(InputPartition):
    path: str
    start: int
    end: int
    size: int


class _LineReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], split_bytes: int):
        self.files, self.split_bytes = files, split_bytes

    def partitions(self) -> Sequence[InputPartition]:
        return [
            _Range(path, start, min(start + self.split_bytes, size), size)
            for path, size in self.files
            for start in range(0, size, self.split_bytes)
        ]

    def read(self, partition: _Range):
        system, path = opened(partition.path)
        with system.open_input_file(path) as file:
            held, size = [], 0
            for lines in lines_of_range(file, partition.start, partition.end, partition.size):
                held += [line.removesuffix(b"\r") for line in lines]
                size += sum(map(len, lines))
                if size >= _BATCH_BYTES:
                    yield self._batch(held)
                    held, size = [], 0
            if held:
                yield self._batch(held)

    def _batch(self, lines: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()).cast(pa.string())], names=["value"])


class BlockGzipText(DataSource):
    """``value``: the lines of the files in option ``files``, in ranges of ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "block_gzip_text"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        files = [tuple(f) for f in json.loads(self.options["files"])]
        return _LineReader(files, int(self.options.get("split_bytes", SPLIT_BYTES)))


def listed(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int]]:
    """Names and sizes of the files that ``paths`` stand for, empty ones included; no file is read."""
    found = spark.read.format("binaryFile").load(list(paths)).select("path", "length")
    return sorted((row.path, row.length) for row in found.collect())


def read_lines(
    spark: SparkSession, files: Sequence[tuple[str, int]], split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """``value``: the lines of block-gzip files, given with their sizes."""
    spark.dataSource.register(BlockGzipText)
    reader = spark.read.format("block_gzip_text").option("split_bytes", str(split_bytes))
    return reader.option("files", json.dumps([list(f) for f in files])).load()


def leading_lines(path: str, mark: str) -> list[str]:
    """The first lines of a file, plain or gzip in any form, that begin with ``mark``."""
    system, name = opened(path)
    found, rest = [], b""
    tool = None
    with system.open_input_stream(name, compression=None) as file:
        while True:
            data = file.read(1 << 16)
            if tool is None:
                tool = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else False
            plain = b""
            if tool is False:
                plain = data
            else:
                left = data
                while left:
                    plain += tool.decompress(left)
                    left = tool.unused_data
                    if tool.eof:
                        tool = zlib.decompressobj(31)
            *lines, rest = (rest + plain).split(b"\n")
            if not data and rest:
                lines.append(rest)
            for line in lines:
                text = line.removesuffix(b"\r").decode()
                if not text.startswith(mark):
                    return found
                found.append(text)
            if not data:
                return found


@dataclass
class _Files(InputPartition):
    paths: list[str]


class _HeadReader(DataSourceReader):
    def __init__(self, paths: list[str], mark: str):
        self.paths, self.mark = paths, mark

    def partitions(self) -> Sequence[InputPartition]:
        return [_Files(self.paths[i : i + FILES_PER_TASK]) for i in range(0, len(self.paths), FILES_PER_TASK)]

    def read(self, partition: _Files):
        for path in partition.paths:
            yield path, leading_lines(path, self.mark)


class LeadingLines(DataSource):
    """``path, lines``: the first lines of every file that begin with option ``mark``."""

    @classmethod
    def name(cls) -> str:
        return "leading_lines"

    def schema(self) -> str:
        return "path string, lines array<string>"

    def reader(self, schema) -> DataSourceReader:
        return _HeadReader(json.loads(self.options["files"]), self.options["mark"])


def headers_of(spark: SparkSession, paths: Sequence[str], mark: str = "#") -> DataFrame:
    """``path, lines, digest``: the leading lines of all files, read side by side in one job."""
    spark.dataSource.register(LeadingLines)
    reader = spark.read.format("leading_lines").option("mark", mark)
    found = reader.option("files", json.dumps(list(paths))).load()
    return found.withColumn("digest", F.sha2(F.array_join("lines", "\n"), 256))
