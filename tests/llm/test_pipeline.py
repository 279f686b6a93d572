"""Every stage of the pipeline against a plain version on whole small tables."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as C
from alleleframe.llm import bpe, mixing, quality
from alleleframe.llm.common import staged
from checks import compare
from .test_minhash_dedup import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, make_docs, small_table):
    """Good and bad documents, exact and near copies, nulls and repeated rows."""
    draw = random.Random(4)
    words = [f"{a}{b}" for a in ("read", "wat", "hous", "peop", "und") for b in ("ing", "er", "e", "le", "ly", "ed")]
    rows = []
    for i in range(240):
        text = " ".join(draw.choices(words, k=draw.choice([8, 40, 150]))) + f" n{i}"
        if i % 4 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        rows.append((i, text, f"src{i % 5}" if i % 7 else None))
    for i in range(240, 300):
        text = rows[1 + draw.randrange(60) * 4][1]
        if i % 2:
            text = text.replace(" ", "  ", 1).title() if i % 3 else text + " end"
        rows.append((i, text, "src9"))
    rows += [(300, None, "src1"), (301, "", "src1"), (302, "reading " * 100_000, "src2"), rows[5], (None, "house water", None)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    return small_table(documents=make_docs(rows), labels=labels)


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The rows before and after each stage."""
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in C.STAGES:
        after = staged(stage(spark, docs, folder), f"test-{name}")
        found[name] = (docs, after)
        docs = after
    return found


def multiset(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_all_but_the_last_keep_the_columns(stages):
    for name, (_, after) in stages.items():
        if name != "tokens":
            assert after.columns == COLUMNS


def test_quality(spark, folder, stages):
    before, after = stages["quality"]
    model = quality.train(before, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = quality.scored(before, model).where("score >= 0.7").select("row.*")
    assert multiset(kept) == multiset(after)
    good = [r for r in before.collect() if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 4]
    left = {r.doc_id for r in after.collect()}
    assert all(r.doc_id in left for r in good)
    assert not any(i in left for i in range(0, 240, 4))


def test_exact_dedup(stages):
    before, after = stages["exact_dedup"]
    lower = lambda t: "".join(c.lower() if c < "\x7f" else c for c in t or "")
    largest = {}
    for r in before.collect():
        if r.doc_id is not None:
            largest[lower(r.text)] = max(r.doc_id, largest.get(lower(r.text), r.doc_id))
    want = Counter(
        {k: n for k, n in multiset(before).items() if k[0] == largest.get(lower(k[1]))}
    )
    assert multiset(after) == want
    assert sum(want.values()) < before.count()


def test_near_dedup(stages):
    before, after = stages["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = Counter(
        row for row, (i, _, c) in zip(rows, brute(rows, 5, 80), strict=True) if i == c
    )
    assert multiset(after) == want
    assert sum(want.values()) < len(rows)


def test_mix(stages, tmp_path):
    before, after = stages["mix"]
    con = compare.duckdb.connect()
    before.write.parquet(str(tmp_path / "documents.parquet"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    sql = mixing.SQL["op8_pareto_mixing"]
    copies = con.execute(f"SELECT doc_id, SUM(copies)::INT FROM ({sql}) GROUP BY doc_id").fetchall()
    counts = Counter(r.doc_id for r in after.select("doc_id").collect())
    assert counts == Counter({i: n for i, n in copies if n})


def test_tokens(stages):
    before, after = stages["tokens"]
    tool = tiktoken.Encoding(
        "test",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    want = Counter(
        (r.doc_id, tuple(tool.encode_ordinary(r.text or "")), hashlib.sha256((r.text or "").encode()).hexdigest())
        for r in before.collect()
    )
    got = Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in after.collect())
    assert got == want


def test_run_is_the_stages_in_order(spark, folder, stages):
    got = Counter((r.doc_id, r.ids_sha256) for r in C.run(spark, folder).collect())
    assert got == Counter((r.doc_id, r.ids_sha256) for r in stages["tokens"][1].collect())
    assert [n for n, _ in C.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "tokens"]
