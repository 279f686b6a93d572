from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from alleleframe.llm import conversation_repair as R

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
FIELDS = [f.name for f in R.RESULT]


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_key, turn_key = (" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(f"{conv_key}:{turn_key}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * (2 if fate == 3 else 1)
    return out


def brute(rows):
    """Forward search over all edit sequences: least (cost, audit) per number of turns used and state."""
    rows = sorted(
        rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest())
    )
    blank = duplicate = truncated = 0
    seen, turns = set(), []
    for _, _, role, text in rows:
        bare = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        must = not bare or (role, text) in seen
        cut = bool(bare) and bare[-1] not in ".!?"
        blank += not bare
        duplicate += bool(bare) and (role, text) in seen
        truncated += bool(bare) and (role, text) not in seen and cut
        seen.add((role, text))
        turns.append((role, text, must, cut))
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}
    for i in range(len(turns) + 1):
        for _ in range(4):  # inserted turns before turn i, or at the end
            for state, (cost, audit, lines) in list(best.items()):
                for c in after[state].replace("s", ""):
                    new = (cost + 3, audit + "I", (*lines, {"u": "user:", "a": "assistant:"}[c]))
                    if c not in best or new[:2] < best[c][:2]:
                        best[c] = new
        if i == len(turns):
            break
        role, text, must, cut = turns[i]
        moved: dict = {}
        for state, (cost, audit, lines) in best.items():
            found = [(state, (cost + 4, audit + "D", lines))]
            if not must:
                extra = cost + 3 * cut
                if role[:1] and role[:1] in after[state]:
                    found.append((role[:1], (extra, audit + "K", (*lines, f"{role}:{text}"))))
                for c, name in (("u", "user"), ("a", "assistant")):
                    if c in after[state]:
                        found.append((c, (extra + 3, audit + "R", (*lines, f"{name}:{text}"))))
            for to, new in found:
                if to not in moved or new[:2] < moved[to][:2]:
                    moved[to] = new
        best = moved
    cost, audit, lines = min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])
    known = [r[1] for r in rows if r[1] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    pairs = zip(turns, turns[1:], strict=False)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)


def expected(rows, damaged=True):
    by = {r[0]: [] for r in rows}
    for row in plain_damage(rows) if damaged else rows:
        by[row[0]].append(row)
    return {conv: brute(some) for conv, some in by.items()}


def found(df):
    rows = df.select("conv_id", *FIELDS).collect()
    got = {r[0]: tuple(r[1:]) for r in rows}
    assert len(got) == len(rows)
    return got


def drawn(seed, conversations, longest, roles=("system", "user", "assistant", "tool", "", None)):
    draw = random.Random(seed)
    texts = ["Yes.", "no", "Why?  ", "  ", "", None, "a\x1f", "Ende!\n", "é\U0001f600."]
    rows = []
    for conv in range(conversations):
        for turn in range(draw.randint(1, longest)):
            text = draw.choice(texts) if draw.random() < 0.5 else f"own {turn}{draw.choice(['.', '', '!'])}"
            role = draw.choice(roles) if draw.random() < 0.4 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn * draw.choice([1, 1, 1, 2]), role, text))
    return rows


def test_costs_alone_equal_brute_force():
    draw = random.Random(5)
    for _ in range(1500):
        n = draw.randint(1, 9)
        rows = [
            (0, i, draw.choice(["system", "user", "assistant", "x"]), draw.choice(["A.", "b", "", f"c{i}.", f"d{i}"]))
            for i in range(n)
        ]
        got = R.solved([r[2] for r in rows], [r[3] for r in rows], [r[1] for r in rows])
        assert tuple(got) == brute(rows)


def test_true_vectors_stay_close():
    draw = random.Random(6)
    for _ in range(300):
        turns = [(draw.choice("suax"), draw.random() < 0.3, draw.random() < 0.3) for _ in range(30)]
        for vector in R.costs_to_go(turns, R.FINAL):
            assert max(vector) - min(vector) <= 10


def test_speculative_vectors_give_the_costs_whatever_follows():
    draw = random.Random(7)
    for _ in range(300):
        turns = [(draw.choice("suax"), draw.random() < 0.5, draw.random() < 0.3) for _ in range(draw.randint(1, 40))]
        later = [(draw.choice("suax"), False, False) for _ in range(draw.randint(0, 5))]
        after = R.costs_to_go(later, R.FINAL)[0]
        costs = R.costs_to_go(turns, after)
        assert R.parallel(R.stitched(R.speculative(turns), after), costs[0])
        for a, b in zip(R.fixed_up(turns, after), costs, strict=True):
            assert R.parallel(a, b)


@pytest.mark.parametrize("chunk_rows", [1, 3, 4096])
def test_chunks_and_partitions_do_not_change_the_result(spark, chunk_rows):
    rows = drawn(1, 25, 12) + drawn(2, 1, 120) + [(None, i, "user", f"x{i}.") for i in range(9)]
    rows += [(77, None, "assistant", "late."), (77, None, "user", "early."), (77, 4, "user", "q?")]
    df = spark.createDataFrame([(r[0] + 100 if i % 2 and r[0] is not None else r[0], *r[1:]) for i, r in enumerate(rows)], SCHEMA)
    plain = [tuple(r) for r in df.collect()]
    got = found(R.with_all(df, R.repair(R.damaged(df), chunk_rows, 7)))
    assert got == expected(plain)


def test_a_conversation_of_repeats_only(spark):
    rows = [(1, i, "user", "same.") for i in range(200)] + [(1, 500, "user", "same.")] * 50
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(R.repair(df, 8, 5))
    assert got == expected(rows, damaged=False)
    assert got[1][2] == 249


def test_all_turns_dropped_and_other_columns(spark):
    gone = [i for i in range(2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0][:3]
    df = spark.createDataFrame([(i, 0, "user", "x") for i in gone], SCHEMA).selectExpr("*", "1 AS at", "'q' AS audit")
    got = found(R.with_all(df, R.repair(R.damaged(df))))
    assert got == {i: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for i in gone}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert R.with_all(df, R.repair(R.damaged(df))).collect() == []


def test_long_text(spark):
    rows = [(1, 0, "user", "w " * 3_000_000 + "."), (1, 1, "assistant", "v" * 5_000_000), (1, 2, "user", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(R.repair(df)) == expected(rows, damaged=False)


def test_the_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select(*SCHEMA.names).collect()]
    assert found(R.op12_conversation_repair(spark, sf_dir)) == expected(rows)
