from __future__ import annotations

import numpy as np
import pytest

from alleleframe.llm import embedding_dedup as X

FIELDS = "vec_id long, embedding array<double>"


def brute(rows, threshold=0.95):
    links = {x: set() for x in range(len(rows))}
    for x, (_, v) in enumerate(rows):
        for y, (_, w) in enumerate(rows[:x]):
            if usable(v) and usable(w) and len(v) == len(w):
                a, b = np.array(v), np.array(w)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    links[x].add(y)
                    links[y].add(x)
    found = []
    for x, (i, v) in enumerate(rows):
        seen, todo = {x}, [x]
        while todo:
            for y in links[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        ids = [rows[y][0] for y in seen if rows[y][0] is not None]
        least = min(ids, default=None) if usable(v) else i
        found.append((i, len(links[x]), least, i == least))
    return sorted(found, key=repr)


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def check(spark, rows):
    found = X.near_vectors(spark.createDataFrame(rows, FIELDS)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows)


def groups(seed, n, size, spread, length=16):
    draw = np.random.default_rng(seed)
    rows = []
    for centre in draw.standard_normal((n, length)):
        rows += [(centre + spread * draw.standard_normal(length)).tolist() for _ in range(size)]
    order = draw.permutation(len(rows))
    return [(int(i), rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("block", [1024, 16])
def test_equal_to_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(X, "BLOCK", block)
    check(spark, groups(3, 12, 18, 0.12))


@pytest.mark.parametrize("mutual", [0.88, 0.93])
def test_pairs_in_a_dense_group_are_found(spark, monkeypatch, mutual):
    """A third of all vectors in one group, in it pairs at 0.955; most are no links but those pairs."""
    monkeypatch.setattr(X, "BLOCK", 32)
    draw = np.random.default_rng(8)
    length, pairs = 256, 700

    def units(n):
        rows = draw.standard_normal((n, length))
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)

    centre = units(1)
    one = mutual**0.5 * centre + (1 - mutual) ** 0.5 * units(pairs)
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    away = units(pairs)
    away -= (away * one).sum(axis=1, keepdims=True) * one
    # The step to the other vector of the pair stays in the group.
    away -= ((away * centre).sum(axis=1) / (1 - (one * centre).sum(axis=1) ** 2))[:, None] * (
        centre - (one * centre).sum(axis=1, keepdims=True) * one
    )
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    other = 0.955 * one + (1 - 0.955**2) ** 0.5 * away
    rows = np.concatenate([one, other, units(4 * pairs)])
    data = [(i, v.tolist()) for i, v in enumerate(rows)]
    found = {r.vec_id: r.component_id for r in X.near_vectors(spark.createDataFrame(data, FIELDS)).collect()}
    assert sum(found[i] == found[i + pairs] for i in range(pairs)) >= 0.99 * pairs
    linked = np.triu(rows @ rows.T >= 0.95, 1)
    missed = [(x, y) for x, y in zip(*np.nonzero(linked), strict=True) if found[x] != found[y]]
    assert len(missed) <= 0.01 * linked.sum()
    assert linked.sum() < 3 * pairs


def test_special_vectors(spark):
    check(
        spark,
        [
            (1, None),
            (2, []),
            (3, [0.0, 0.0]),
            (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]),
            (6, [None, 1.0]),
            (7, [1.0, 2.0]),
            (8, [2.0, 4.0]),
            (8, [2.0, 4.0]),
            (9, [-1.0, -2.0]),
            (10, [1.0, 2.0, 0.0]),
            (None, [1.0, 2.1]),
            (11, [0.0, 1.0]),
            (12, [-0.0, 1.0]),
            (13, [1e150, 3.0]),
            (14, [1e-150, 0.0]),
        ],
    )


def test_empty_table_and_extra_columns(spark):
    assert X.near_vectors(spark.createDataFrame([], FIELDS)).collect() == []
    rows = spark.createDataFrame([(1, [1.0]), (2, [2.0])], FIELDS).selectExpr("*", "1 AS node", "2 AS size")
    assert X.near_vectors(rows).columns == ["vec_id", "n_links", "component_id", "kept"]


def test_threshold_is_in_double_precision():
    one = np.array([[1.0, 0.0]])
    for sign, want in ((1e-12, True), (-1e-12, False)):
        cosine = 0.95 + sign
        assert X._linked(one, np.array([[cosine, (1 - cosine**2) ** 0.5]]), 0.95)[0, 0] == want


def test_passes_grow_with_the_rows():
    needed = [X.passes_needed(n) for n in (10, 1000, 10**5, 10**7, 10**9)]
    assert needed[0] == 1
    assert needed == sorted(needed)
    assert needed[-1] < 200
