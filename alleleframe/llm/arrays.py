"""Numpy views of Arrow text columns and hashes of the words in them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
#: Bytes handled at a time: each needs a few dozen bytes of working memory.
CHUNK = 1 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column without nulls, one after another, and their offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    marks = np.frombuffer(offsets, np.int64 if wide else np.int32)
    marks = marks[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[marks[0] : marks[-1]], marks - marks[0]


def spans(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``size`` bytes each; a longer row is a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def small_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a few MB of ``text`` each, or of one row that has more."""
    _, offsets = text_bytes(batch.column("text"))
    for first, last in spans(offsets, 4 * CHUNK):
        yield batch.slice(first, last - first)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; equal in, equal out, and nothing else."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


def run_hashes(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo 2^64 of the runs that begin at ``starts`` and follow each other."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, len(symbols)))
    powers = np.full(int(lengths.max()), _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    place = np.arange(len(symbols)) - np.repeat(starts, lengths)
    return mixed(np.add.reduceat((symbols.astype(np.uint64) + np.uint64(1)) * powers[place], starts))


GAP = np.zeros(256, bool)
GAP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts with A-Z in lower case, and the word offsets of the texts.

    Texts are cut into chunks between words, so that working memory stays small
    however long a text is.
    """
    found, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for first, last in spans(offsets):
        begin, end = int(offsets[first]), int(offsets[last])
        while begin < end:
            stop = end
            if last == first + 1 and end - begin > CHUNK:
                gap = np.flatnonzero(GAP[data[begin + CHUNK : end]])
                stop = begin + CHUNK + int(gap[0]) + 1 if len(gap) else end
            part = data[begin:stop]
            marks = np.clip(offsets[first:last] - begin, 0, None)
            inside = ~GAP[part]
            fresh = inside.copy()
            fresh[1:] &= ~inside[:-1]
            at = marks[marks < len(part)]
            fresh[at] |= inside[at]
            where = np.flatnonzero(fresh)
            # Offsets of the words among the bytes that belong to words.
            starts = (np.cumsum(inside) - 1)[where]
            found.append(run_hashes(_LOWER[part[inside]], starts))
            row = first + np.searchsorted(marks, where, "right") - 1
            counts += np.bincount(row, minlength=len(counts))
            begin = stop
    words = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return words, np.concatenate([[0], np.cumsum(counts)])


class WordDigests(dict):
    """64 bits of a digest of each word asked for; words are kept up to a bounded number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 19:
            self.clear()
        found = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = found
        return found


_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def word_digests(data: bytes, known: WordDigests) -> np.ndarray:
    """Digests of the words of one text with A-Z in lower case, in order.

    Unlike ``word_hashes`` these are from a cryptographic digest of the bytes, so
    words that differ have different numbers also if someone looks for equal ones.
    """
    found, begin = [], 0
    while begin < len(data):
        end = len(data)
        if end - begin > CHUNK:
            gap = _WHITE.search(data, begin + CHUNK)
            end = gap.start() if gap else end
        words = data[begin:end].lower().split()  # of bytes: A-Z and ASCII white space only
        found.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        begin = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width`` words in a row; of all words if there are fewer."""
    if len(words) == 0:
        return words
    wide = min(width, len(words))
    total = np.full(len(words) - wide + 1, np.uint64(wide))
    for k in range(wide):
        total = mixed(total * np.uint64(_BASE) + words[k : len(words) - wide + 1 + k])
    return np.unique(total)


def whole_groups(batches, columns):
    """Tables that hold whole groups of rows sorted by ``columns``, and the groups' first rows."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest is not None else rows
        if rows.num_rows == 0:
            continue
        change = np.zeros(rows.num_rows, bool)
        change[0] = True
        for name in columns:
            values = rows.column(name).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        first = np.flatnonzero(change)
        rest = rows.slice(first[-1])
        if len(first) > 1:
            yield rows.slice(0, first[-1]), first
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])


def spanning(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A link to the smallest place of its component for each place that has one.

    ``linked`` says which of the places ``rows`` are linked with which of
    ``columns``; a place may be in both.
    """
    if not linked.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = int(min(rows.min(), columns.min()))
    rows, columns = rows - first, columns - first
    n = int(max(rows.max(), columns.max())) + 1
    label = np.arange(n)
    while True:
        new = label.copy()
        new[rows] = np.minimum(new[rows], np.where(linked, new[columns][None, :], n).min(axis=1))
        new[columns] = np.minimum(new[columns], np.where(linked, new[rows][:, None], n).min(axis=0))
        new = new[new]
        if (new == label).all():
            break
        label = new
    apart = np.flatnonzero(label != np.arange(n))
    return apart + first, label[apart] + first
