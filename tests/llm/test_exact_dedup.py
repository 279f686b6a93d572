from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from alleleframe.llm import exact_dedup as E


@settings(max_examples=60, deadline=None)
@given(
    st.dictionaries(st.integers(0, (1 << 64) - 1), st.integers(1, 70_000), min_size=1, max_size=50),
    st.integers(0, 12),
)
def test_filter_keeps_everything(content, block_bits):
    by_block = {}
    for value, count in content.items():
        by_block.setdefault(value >> (64 - block_bits), {})[value] = count
    for block, some in by_block.items():
        prints = np.array(sorted(some), np.uint64)
        counts = np.array([some[int(p)] for p in prints], np.uint64)
        back = E.decode_filter(E.encode_filter(prints, counts, block_bits), block, block_bits)
        assert back[0].tolist() == prints.tolist()
        assert back[1].tolist() == counts.tolist()


def test_merged_filters_add_counts():
    one = (np.array([1, 5, 9], np.uint64), np.array([1, 2, 1], np.uint64))
    other = (np.array([5, 7], np.uint64), np.array([1, 1], np.uint64))
    prints, counts = E.merge_filters([one, other])
    assert prints.tolist() == [1, 5, 7, 9]
    assert counts.tolist() == [1, 3, 1, 1]


def expected(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""), []).append(i)
    found = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        found += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return sorted(found, key=repr)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, "a"), (2, "A"), (3, "b")],
        [(1, None), (2, ""), (3, " ")],
        [(1, "Ä"), (2, "ä"), (3, "Ä")],
        [(1, "x" * 300_000), (2, "X" * 300_000), (3, "x" * 300_001)],
        [(7, "a"), (7, "a"), (7, "b"), (9, "b")],
        [(None, "a"), (3, "A"), (None, "c"), (None, "d"), (None, "D")],
    ],
)
def test_groups(make_docs, rows):
    found = E.exact_groups(make_docs([(i, t, "s") for i, t in rows])).drop("text_hash")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def test_hot_text_and_extra_columns(make_docs):
    rows = [(i, "The same" if i % 3 else f"own {i}", "s") for i in range(600)]
    docs = make_docs(rows).selectExpr("*", "1 AS kept", "text AS digest", "2 AS row")
    rest = E.without_copies(docs)
    assert rest.columns == docs.columns
    kept = {r.doc_id for r in rest.collect()}
    assert kept == {i for i in range(600) if i % 3 == 0} | {599}


def test_rows_with_one_id_and_different_texts(make_docs):
    rest = E.without_copies(make_docs([(1, "a", "s"), (1, "b", "s"), (2, "a", "s")]))
    assert sorted((r.doc_id, r.text) for r in rest.collect()) == [(1, "b"), (2, "a")]


def test_one_row_of_each_text_stays_whatever_the_ids(make_docs):
    rows = [(7, "a", "s"), (7, "a", "t"), (7, "A", "s"), (7, "b", "s"), (3, "a", "s"), (1, "c", "s"), (1, "c", "s")]
    rows += [(None, t, s) for t in ("D", "d", "d", "b", "e") for s in ("s", None)] + [(None, None, None), (None, "", "s")]
    rest = sorted(E.without_copies(make_docs(rows)).collect(), key=repr)
    assert sorted((r.text or "").lower() for r in rest) == ["", "a", "b", "c", "d", "e"]
    assert {(r.doc_id, r.text.lower()) for r in rest if r.doc_id} == {(7, "a"), (7, "b"), (1, "c")}
    assert rest == sorted(E.without_copies(make_docs(rows[::-1]).repartition(5)).collect(), key=repr)
    twice = make_docs([(i, f"own {i}", "s") for i in range(50)] * 2)
    assert E.without_copies(twice).count() == 50


def test_odd_names_of_further_columns(make_docs):
    docs = make_docs([(1, "a", "s"), (2, "A", "t"), (2, "A", "s")]).selectExpr("*", "1 AS `x.y`", "2 AS `z``q`")
    kept = E.without_copies(docs)
    assert kept.columns == docs.columns
    assert [(r.doc_id, r["x.y"]) for r in kept.collect()] == [(2, 1)]
