from __future__ import annotations

import pytest

from alleleframe.llm import mixing as M
from checks import compare


def corpus(make_docs, sizes):
    """Documents with so many words per source."""
    rows = []
    for source, words in sizes.items():
        rows += [(len(rows) + k, " ".join(["w"] * n), source) for k, n in enumerate(words)]
    return make_docs(rows)


def taken(spark, docs, small_table):
    return M.op8_pareto_mixing(spark, small_table(documents=docs))


def test_targets_share_the_excess(spark, make_docs):
    sized = spark.createDataFrame(
        [("a", 10), ("b", 1000), ("c", 100), ("d", 500), (None, 390)], "mix_source string, size long"
    )
    found = {r.mix_source: r.target for r in M.source_targets(sized).collect()}
    # Weights 5, 2, 1, 5, 2 share 2000 words; a is capped at 30, then its excess is shared.
    assert found["a"] == 30
    level = (2000 - 30) / 10
    assert found["c"] == pytest.approx(level)
    assert found["b"] == pytest.approx(2 * level)
    assert found[None] == pytest.approx(2 * level)
    assert found["d"] == pytest.approx(5 * level)
    assert sum(found.values()) == pytest.approx(2000)


def test_caps_follow_each_other(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 30), ("c", 960)], "mix_source string, size long")
    found = {r.mix_source: r.target for r in M.source_targets(sized).collect()}
    assert found == {"a": 30.0, "b": 90.0, "c": 880.0}


def test_query_equals_sql_with_nulls_and_ties(spark, make_docs, small_table):
    rows = [(i, "w " * (i * 7919 % 23), ["a", "b", None, "é", "z"][i % 5 if i % 3 else 0]) for i in range(800)]
    folder = small_table(documents=make_docs(rows + [(900, None, "a"), (901, "", "only empty")]))
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    found = M.op8_pareto_mixing(spark, folder)
    assert compare.differences(found, con, M.SQL["op8_pareto_mixing"]) == []


def test_words_come_near_the_target_and_reruns_agree(spark, make_docs, small_table):
    sizes = {"a": [5] * 300, "b": [3, 50, 8, 1, 20] * 200, "c": [2] * 2000}
    docs = corpus(make_docs, sizes)
    folder = small_table(documents=docs)
    rows = M.op8_pareto_mixing(spark, folder).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, M.op8_pareto_mixing(spark, folder).collect()))
    by_target = {}
    for r in rows:
        assert r.taken <= 3 * r.size
        by_target.setdefault((r.target, r.source_size), []).append(r)
    for (target, _), some in by_target.items():
        assert abs(sum(r.taken for r in some) - target) <= max(r.size for r in some) / 2


def test_unequal_weights_prefer_heavy_documents(make_docs):
    docs = corpus(make_docs, {"a": [4] * 2000, "b": [4] * 4000})
    docs = docs.selectExpr("*", "CASE WHEN doc_id % 2 = 0 THEN 1.0 ELSE 4.0 END AS share")
    mixed = M.mix(docs, weights=(1, 8), weight="share")
    assert mixed.columns == docs.columns
    counts = {(r.source, r.share): r["count"] for r in mixed.groupBy("source", "share").count().collect()}
    # 24,000 words, 1 to 8; documents of b are limited to 3 copies if heavy.
    words = {s: 4 * sum(n for (of, _), n in counts.items() if of == s) for s in "ab"}
    assert words["a"] == pytest.approx(24_000 / 9, abs=4)
    assert words["b"] == pytest.approx(24_000 * 8 / 9, abs=4)
    assert counts["a", 4.0] == pytest.approx(4 * counts["a", 1.0], rel=0.25)
    assert counts["b", 4.0] > 1.5 * counts["b", 1.0]


@pytest.mark.parametrize(
    "rows", [[], [(1, None, None)], [(1, "a b", "s")], [(None, "a", "s"), (None, "b c", "s"), (3, "d", "t")]]
)
def test_special_tables(spark, make_docs, small_table, rows):
    docs = make_docs(rows).selectExpr("*", "0 AS mix_copies", "1 AS row", "2 AS target")
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() <= 3 * len(rows)
    assert taken(spark, docs, small_table).count() == len(rows)


def test_a_source_of_equal_ids_is_taken_together(make_docs):
    rows = [(7, "a b", "s")] * 10 + [(i, "a b", "t") for i in range(10, 20)]
    kept = [r.doc_id for r in M.mix(make_docs(rows)).collect() if r.doc_id == 7]
    assert len(kept) % 10 == 0


@pytest.mark.parametrize("shared", [None, 7])
def test_rows_that_share_an_id_are_drawn_one_by_one(make_docs, shared):
    rows = [(shared, f"w{i} b c d", "a") for i in range(300)] + [(i, f"w{i} b c d", "a") for i in range(1000, 1600)]
    rows += [(i, "w b c d", "b") for i in range(2000, 2900)]
    docs = M.mix(make_docs(rows), weights=(1, 2))
    counts = {}
    for r in docs.where("source = 'a'").collect():
        counts[r.doc_id, r.text] = counts.get((r.doc_id, r.text), 0) + 1
    # 7,200 words, 1 to 2: two thirds of the rows of a are taken, also of those that share the id.
    assert sum(counts.values()) == 600
    assert set(counts.values()) == {1}
    assert 160 <= sum(i == shared for i, _ in counts) <= 240
