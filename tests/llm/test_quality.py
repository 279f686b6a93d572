from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from alleleframe.llm import arrays, quality

GOOD = "the of and thing reading water over under house people going where there".split()


def texts(n, seed=1):
    draw = random.Random(seed)
    found = []
    for i in range(n):
        words = draw.choices(GOOD, k=draw.randint(15, 120))
        found.append((i, " ".join(words if i % 4 else [w.upper() + "!!" for w in words]), "s"))
    return found


@pytest.fixture(scope="module")
def folder(spark, make_docs, small_table):
    rows = texts(400)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _, _ in rows], "doc_id long, quality int, toxic int")
    docs = make_docs(rows + [(1000, None, "s"), (1001, "", "s"), (1002, "go " * 500_000, "s")])
    return small_table(documents=docs, labels=labels)


def test_held_out_accuracy(spark, folder):
    rows = {r.doc_id: r for r in quality.op9_quality_classifier(spark, folder).collect()}
    assert len(rows) == 403
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)
    held = [r for i, r in rows.items() if r.held_out and i < 400]
    right = sum(r.predicted == int(r.doc_id % 4 > 0) for r in held)
    assert len(held) > 60
    assert right >= 0.98 * len(held)
    assert rows[1000].score == rows[1001].score


def test_held_out_labels_have_no_influence(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn(
        "quality", quality.F.when(quality.held_out(labels.doc_id), 1 - labels.quality).otherwise(labels.quality)
    )
    one, other = quality.train(docs, labels), quality.train(docs, turned)
    assert one[1] == other[1]
    assert (one[0] == other[0]).all()


def test_without_labels_all_scores_are_equal(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = make_docs(["a b", None, "c"])
    assert {r.score for r in quality.scored(docs, quality.train(docs, none)).collect()} == {0.5}


def test_special_rows(spark, make_docs):
    labels = spark.createDataFrame(
        [(0, 1), (0, 1), (1, 0), (None, 1), (3, None), (77, 1)], "doc_id long, quality int"
    )
    docs = make_docs([(0, "fine text", "s"), (0, "fine text", "s"), (1, "BAD!!", "s"), (None, "x", None)])
    docs = docs.selectExpr("*", "1 AS score", "2 AS quality", "3 AS row")
    rest = quality.without_rejected(docs, labels, threshold=0.0)
    assert rest.columns == docs.columns
    assert rest.count() == 4
    assert quality.scored(docs.limit(0), quality.train(docs, labels)).count() == 0


def test_features_do_not_depend_on_chunks(monkeypatch):
    data = b"one two  two\nthree a bc def ghij klmno"
    array, offsets = np.frombuffer(data, np.uint8), np.array([0, len(data)])

    def found():
        return sorted(np.concatenate([b for _, b in quality.features(array, offsets)]).tolist())

    whole = found()
    monkeypatch.setattr(arrays, "CHUNK", 6)
    monkeypatch.setattr(quality, "CHUNK", 6)
    assert found() == whole


def test_other_labels_are_no_labels(spark, make_docs):
    docs = make_docs([f"text number {i} {'good' if i % 2 else 'bad'}" for i in range(40)])
    rows = [(i, i % 2, 0) for i in range(40)]
    odd = [(1, 7, 0), (2, None, 0), (3, -1, 0)]
    schema = "doc_id long, quality int, toxic int"
    plain = quality.train(docs, spark.createDataFrame(rows, schema))
    more = quality.train(docs, spark.createDataFrame(rows + odd, schema))
    assert (plain[0] == more[0]).all() and plain[1] == more[1]
