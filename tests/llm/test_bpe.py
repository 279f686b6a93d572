from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from alleleframe.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    "",
    None,
    "it's we'll I've 'sfoo 'tis  \n\n x\t\ty   ",
    "   ",
    "'",
    "a'",
    "''s x 's y's 's're 'r 'LL 'S",
    "　a  b²³ Ⅷ 12٣ \U0001f600\U0001f600 é ‍",
    "\x1c\x1d a\x85b\xa0c",
    "a" * 5000 + " " * 70 + "b",
]


@pytest.fixture(scope="module")
def tool():
    return tiktoken.Encoding(
        "test",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(PATH),
        special_tokens={},
    )


def test_round_trip_equals_the_library(make_docs, tool):
    draw = random.Random(3)
    letters = "ab'sretvlmd  \n\t\r12²!? é　'中"
    texts = TEXTS + ["".join(draw.choices(letters, k=draw.randint(1, 60))) for _ in range(1500)]
    found = {r.doc_id: r for r in bpe.round_trip(make_docs(texts), PATH, with_ids=True).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        ids = tool.encode_ordinary(text or "")
        assert found[i].ids == ids, text
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def twins(size):
    """Two words of ``a`` and ``b`` whose polynomial hashes modulo 2^64 are equal for any base."""
    first = "".join("ab"[bin(i).count("1") & 1] for i in range(size))
    return first, first.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_words_are_told_apart_by_their_bytes(make_docs, tool, size):
    texts = [*twins(size), " ".join(twins(size))]
    found = {r.doc_id: r for r in bpe.round_trip(make_docs(texts), PATH, with_ids=True).collect()}
    for i, text in enumerate(texts):
        assert found[i].ids == tool.encode_ordinary(text)
        assert found[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_slices_do_not_change_the_result(make_docs, tool, monkeypatch):
    texts = ["", *(f"word {i % 7} and {i % 11}!" * (i % 9) for i in range(60)), ""]
    monkeypatch.setattr(bpe, "SLICE", 10)
    found = {r.doc_id: r for r in bpe.round_trip(make_docs(texts), PATH, with_ids=True).collect()}
    for i, text in enumerate(texts):
        ids = tool.encode_ordinary(text)
        assert found[i].ids == ids
        assert found[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_blocks_do_not_change_the_result(make_docs):
    docs = make_docs([f"word {i % 7} and {i % 11}!" * (1 + i % 5) for i in range(300)])
    many = bpe.encode(docs, PATH, block_size=50)
    few = bpe.encode(docs, PATH)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))


def test_documents_with_one_id_or_none(make_docs, tool):
    docs = make_docs([(5, "one two", "s"), (5, "three", "s"), (None, "four", "s")])
    found = sorted((str(r.doc_id), r.ids) for r in bpe.encode(docs, PATH).collect())
    assert found == sorted(
        (i, tool.encode_ordinary(t)) for i, t in (("5", "one two"), ("5", "three"), ("None", "four"))
    )


def test_decoding_joins_the_token_table(make_docs):
    texts = ["a b  c", "", "é\U0001f600 \n", "x" * 3000]
    found = bpe.decoded(bpe.encode(make_docs(texts), PATH), PATH)
    assert {r.doc_id: bytes(r.data).decode() for r in found.collect()} == dict(enumerate(texts))


def test_empty_table(make_docs):
    assert bpe.round_trip(make_docs([]), PATH).collect() == []


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2097151, 2097152, 3000000])
    assert bpe.unpack(bpe.pack(values)).tolist() == values.tolist()
