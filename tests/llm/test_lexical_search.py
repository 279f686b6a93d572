from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from alleleframe.llm import lexical_search as S

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    read = [(i, terms(t)) for i, t in docs]
    read = [(i, t) for i, t in read if t]
    n_docs, n_terms = len(read), sum(len(t) for _, t in read)
    df = Counter(term for _, t in read for term in set(t))
    out = []
    for item_id, text in set(items):
        scores = []
        for doc_id, t in read:
            tf, m = Counter(t), 10 + (90 * len(t) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                * ((1_000_000_000 * tf[x]) // (1000 * tf[x] + 8 * m))
                for x in set(terms(text))
                if x in tf
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scores)[:top], 1):
            out.append((item_id, rank, None if none else doc_id, -score))
    return sorted(out, key=repr)


def found(spark, docs, items, **more):
    rows = S.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **more)
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows.collect()), key=repr)


def drawn(seed, n):
    draw = random.Random(seed)
    pool = ["The", "the", "of", "é", "Ünder", "x1", "42", "語", *(f"w{i}" for i in range(80))]
    weights = [1 / (i + 1) for i in range(len(pool))]
    sep = [" ", "\n", "_", "-", "\x00", "…"]
    return [
        (i, draw.choice(sep).join(draw.choices(pool, weights, k=draw.randint(0, 40)))) for i in range(n)
    ]


@pytest.mark.parametrize("postings", [1, 50, S.POSTINGS])
def test_equal_to_brute_force(spark, postings):
    docs = drawn(1, 150) + [(i + 500, "the same text 42") for i in range(30)] + [(7, "w1 w2"), (None, "w1 w2"), (None, "w1 w2")]
    items = [(i, t) for i, t in drawn(2, 12)] + [(3, "w1 w2"), (3, "w1 w2"), (3, "x1"), (None, "the same"), (90, None), (91, "absent")]
    assert found(spark, docs, items, postings=postings) == brute(docs, items)


def test_items_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "ITEMS", 3)
    docs, items = drawn(3, 60), drawn(4, 20)
    assert found(spark, docs, items) == brute(docs, items)


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 50)
    monkeypatch.setattr(S, "HELD", 20)
    docs = [(1, "a b c " * 300 + "d"), (2, "e" * 500 + " a"), (3, " " * 400)]
    items = [(1, "a d"), (2, "e" * 500)]
    assert found(spark, docs, items) == brute(docs, items)


def test_long_text_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "word " * 600_000 + "rare"), (2, "word")], DOCS).selectExpr("*", "1 AS shard", "2 AS terms")
    items = spark.createDataFrame([(5, "rare word")], ITEMS).selectExpr("*", "3 AS item", "4 AS rank")
    rows = [(r["rank"], r.doc_id) for r in S.search(docs, items).collect()]
    assert sorted(rows) == [(1, 1), (2, 2)] or sorted(rows) == [(1, 2), (2, 1)] or sorted(rows) == [(1, 1)]
    assert (1, 1) in rows


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a"), (2, "b")], []) == []
    assert found(spark, [(1, None), (2, "  ")], [(1, "a")]) == []


def test_a_tree_gives_back_its_grid():
    draw = np.random.default_rng(4)
    place = draw.choice(70 * 300, 900, replace=False)
    row, column, impact = place // 300, place % 300, draw.integers(1, 10**6, 900)
    packed = S.pack_tree(row, column, impact)
    tree = S.Tree(packed["height"], packed["n_cells"], 900, packed["masks"], packed["drops"])
    for r in range(70):
        wanted = sorted(((-v, c) for x, c, v in zip(row.tolist(), column.tolist(), impact.tolist()) if x == r))
        got = S.best_of_tree(tree, np.array([r]), np.array([1]), 1000)
        assert [(-s, c) for s, c in got] == wanted


def test_few_ranges_are_opened(monkeypatch):
    """The best document of a large grid is found without walking all of it."""
    draw = np.random.default_rng(5)
    row, column = np.divmod(np.sort(draw.choice(50 * 20_000, 100_000, replace=False)), 20_000)
    impact = draw.integers(1, 1000, len(row))
    at = (row == 3).nonzero()[0][100]
    impact[at] = 10**6
    packed = S.pack_tree(row, column, impact)
    tree = S.Tree(packed["height"], packed["n_cells"], len(row), packed["masks"], packed["drops"])
    opened, plain = [], S.Tree.opened

    def counted(self, level, cells, rows):
        opened.append(len(cells))
        return plain(self, level, cells, rows)

    monkeypatch.setattr(S.Tree, "opened", counted)
    assert S.best_of_tree(tree, np.array([3, 4]), np.array([5, 1]), 1)[0][1] == column[at]
    assert sum(opened) < 1500
