from __future__ import annotations

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T

from alleleframe.llm import language_id as L

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
    ]
)


def all_ways(word, number, chances):
    """Probability of a word in each language, by listing its segmentations."""
    text = "▁" + word

    def ways(i):
        if i == len(text):
            yield []
            return
        for j in range(i + 1, len(text) + 1):
            found = number.get(text[i:j], len(number) if j == i + 1 else None)
            if found is not None:
                for rest in ways(j):
                    yield [found, *rest]

    return list(ways(0))


def random_model(seed=1):
    draw = np.random.default_rng(seed)
    pieces = sorted({"▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab", "c", "bc"})
    chances = draw.random((len(pieces) + 1, 3))
    return pieces, {p: i for i, p in enumerate(pieces)}, chances / chances.sum(axis=0)


WORDS = ["a", "ab", "abab", "bcab", "abaé", "x", "ababcbaab"]


def test_forward_sums_all_segmentations():
    _, number, chances = random_model()
    logs = L.word_logs(WORDS, number, chances)
    for word, log in zip(WORDS, logs, strict=True):
        whole = sum(np.prod(chances[way], axis=0) for way in all_ways(word, number, chances))
        assert np.allclose(np.log(whole), log)


def test_expected_counts_weigh_all_segmentations():
    _, number, chances = random_model(2)
    counts = np.arange(len(WORDS) * 3, dtype=float).reshape(-1, 3)
    wanted = np.zeros_like(chances)
    for word, n in zip(WORDS, counts, strict=True):
        ways = all_ways(word, number, chances)
        odds = np.array([np.prod(chances[way], axis=0) for way in ways])
        for way, share in zip(ways, odds / odds.sum(axis=0), strict=True):
            for piece in way:
                wanted[piece] += share * n
    assert np.allclose(L.expected_counts(WORDS, counts, number, chances), wanted)


def test_words_of_long_texts_are_those_of_short_ones(monkeypatch):
    text = "One two_three 4four ŞİŞ ß² " * 40 + "x" * 100
    short = [w for some in L.words_of(text) for w in some]
    monkeypatch.setattr(L, "PIECE", 37)
    assert [w for some in L.words_of(text) for w in some] == short
    assert max(map(len, short)) == L.LONGEST


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(3)
    stock = {"aa": ["the", "of", "and", "wind", "stone"], "bb": ["der", "und", "wind", "stein", "ein"]}
    rows = []
    for i in range(400):
        lang = draw.choice(["aa", "bb"])
        rows.append((i, " ".join(draw.choices(stock[lang], k=draw.randint(3, 20))), lang))
    return rows


def test_prediction_equals_a_plain_model(spark, corpus):
    pieces = L.vocabulary(public_tokenizers.path(L.VOCABULARY))
    docs = spark.createDataFrame(corpus, DOCS)
    model = L.train(docs, pieces, per_language=50, rounds=2)
    assert model.languages == ["aa", "bb"]
    assert np.allclose(model.chances.sum(axis=0), 1)
    number = {p: i for i, p in enumerate(pieces)}
    got = {r.doc_id: r for r in L.predicted(docs, model).collect()}
    right = 0
    for i, text, lang in corpus:
        total = np.log(model.shares)
        for word in text.split():
            total = total + np.log(sum(np.prod(model.chances[w], axis=0) for w in all_ways(word, number, model.chances)))
        best = int(total.argmax())
        assert got[i].lang_pred == model.languages[best]
        assert math.isclose(got[i].score, 1 / np.exp(total - total[best]).sum(), rel_tol=1e-9)
        right += got[i].lang_pred == lang
    assert right >= 396


def test_held_out_rows_and_other_columns_are_never_learned_from(spark, corpus):
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in corpus]
    pieces = L.vocabulary(public_tokenizers.path(L.VOCABULARY))
    frames = [spark.createDataFrame(rows, DOCS).selectExpr("*", "lang AS source", "1 AS score") for rows in (corpus, other)]
    a, b = (L.train(df, pieces, rounds=1) for df in frames)
    assert a.languages == b.languages
    assert np.array_equal(a.chances, b.chances)


def test_special_rows(spark, corpus):
    pieces = L.vocabulary(public_tokenizers.path(L.VOCABULARY))
    model = L.train(spark.createDataFrame(corpus, DOCS), pieces, rounds=1)
    rows = [(1, None, "aa"), (2, "", None), (3, " 12 ² !?", "aa"), (None, "the der", None), (4, "the " * 400_000, "bb")]
    rows += [(4, "und", "bb"), (5, "語" * 3000, None), (6, "Ⅷ", None)]
    found = [(r.doc_id, r.lang_pred, r.score) for r in L.predicted(spark.createDataFrame(rows, DOCS), model).collect()]
    assert len(found) == len(rows)
    assert {(i, p, s) for i, p, s in found if p == "und"} == {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (6, "und", 0.0)}
    assert (4, "aa") in {(i, p) for i, p, _ in found} and (4, "bb") in {(i, p) for i, p, _ in found}
    assert all(0 <= s <= 1 for _, _, s in found)


def test_nothing_to_learn_from(spark):
    pieces = ["▁", "a"]
    docs = spark.createDataFrame([(1, "a b", None)], DOCS)
    assert [(r.lang_pred, r.score) for r in L.predicted(docs, L.train(docs, pieces)).collect()] == [("und", 0.0)]
    empty = spark.createDataFrame([], DOCS)
    assert L.predicted(empty, L.train(empty, pieces)).collect() == []


def test_the_query_on_held_out_rows(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = L.op13_language_id(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
