from __future__ import annotations

import random
import re

import pytest

from alleleframe.llm import line_dedup as L

MARKS = ".!?,;:\n。！？，；：、"


def cut(text):
    """start, end, size, normalised text of the units, character by character."""
    pieces, at = [], 0
    for i in range(1, len(text) + 1):
        if i == len(text) or (text[i - 1] in MARKS and text[i] not in MARKS):
            pieces.append((at, i))
            at = i
    out = []
    for a, b in pieces:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text[a:b])
        words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
        plain = " ".join(words)
        if any(c not in MARKS + " " for c in plain):
            out.append((a, b, max(len(words), len(plain.encode()) // 10), plain))
    return out


def brute(rows, least):
    docs = sorted({(i is None, i or 0, text or "") for i, text, *_ in rows})
    count, all_rows = {}, [(i is None, i or 0, text or "") for i, text, *_ in rows]
    for _, _, text in all_rows:
        for *_, plain in cut(text):
            count[plain] = count.get(plain, 0) + 1
    first, listed = {}, []
    for none, i, text in docs:
        for unit, (*_, plain) in enumerate(cut(text)):
            first.setdefault(plain, set()).add((none, i, unit, text))
    for none, i, text in docs:
        run = []
        for unit, entry in [*enumerate(cut(text)), (None, None)]:
            if entry and count[entry[3]] > 1:
                run.append((unit, *entry))
                continue
            if sum(r[3] for r in run) >= least:
                listed += [(none, i, text, *r, sum(x[3] for x in run)) for r in run]
            run = []
    out = set()
    for none, i, text, unit, a, b, size, plain, total in listed:
        least_key = min(x[:3] for x in first[plain])
        same = {x[3] for x in first[plain] if x[:2] == least_key[:2]}
        if len(same) == 1 and (none, i, unit) == least_key:
            continue
        out.add((None if none else i, unit, a, b, size, total))
    return out


def check(make_docs, rows, least=L.RUN):
    found = L.repeated_units(make_docs(rows), least).collect()
    assert {(r.doc_id, r.unit, r.start, r.end, r.size, r.run_size) for r in found} == brute(rows, least)


@pytest.mark.parametrize("least", [1, 6, 15])
def test_equal_to_brute_force(make_docs, least):
    draw = random.Random(least)
    pool = [" ".join(draw.choices(["Ä", "the", "Of", "é\U0001f600", "x\t", "and"], k=draw.randint(1, 9))) for _ in range(60)]
    rows = [
        (i, "".join(draw.choice(pool) + draw.choice(["\n", ". ", ", ", "。", "!?", ""]) for _ in range(draw.randint(0, 9))), "s")
        for i in range(200)
    ]
    check(make_docs, rows, least)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None, "s"), (2, "", "s"), (3, "\n\n", "s"), (4, " ., ", "s")],
        [(None, "one two three four five", "s"), (3, "ONE  two three four\tfive", "s")],
        [(3, "a b c d e\nA b c d e", "s"), (3, "a b c d e\nA b c d e", "s")],
        [(2, "w " * 200_000, "s"), (1, "W " * 200_000, "s")],
        [(2, "x, y. " * 300, "s"), (1, "x, y. ", "s")],
    ],
)
def test_special_rows(make_docs, rows):
    check(make_docs, rows, 5)


def test_different_texts_under_no_id_are_different_documents(make_docs):
    shared = "a passage of some words, " * 3
    docs = make_docs([(None, f"own start {i}. {shared}", "s") for i in range(3)])
    rows = L.repeated_units(docs, 5).select("start", "end").collect()
    assert len(rows) >= 3 + 2 * 2


PASSAGE = (
    "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew, and the evil queen "
    "watches. jack quietly moves up front to seize the big ball of wax; nobody asks why the five boxing "
    "wizards jump so fast on that cold and windy day in the north, nor who counts them."
)


def test_a_passage_inside_longer_lines_goes_but_once(make_docs):
    texts = [f"Text {i} begins its own way and {PASSAGE} here it ends {i}, differently." for i in range(4)]
    rows = {r.doc_id: r for r in L.without_repeats(make_docs(texts)).collect()}
    assert rows[0].text == texts[0]
    for i in (1, 2, 3):
        assert "jack quietly" not in rows[i].text
        assert rows[i].text.startswith(f"Text {i} begins its own way")
        assert rows[i].text.endswith(f"here it ends {i}, differently.")


def test_short_common_lines_stay(make_docs):
    texts = [f"Document {i} says this.\nAll rights reserved.\nPage {i} of many. Thank you." for i in range(30)]
    docs = make_docs(texts).selectExpr("*", "1 AS unit", "2 AS digest", "3 AS removed")
    assert sorted(r.text for r in L.without_repeats(docs).collect()) == sorted(texts)
    assert L.repeated_units(docs, 1).where("doc_id = 3").count() == 2


def test_scripts_without_spaces(make_docs):
    passage = "".join(f"{i}番目の文は多くの文書に現れる長い一節です。" for i in range(20))
    texts = {r.doc_id: r for r in L.without_repeats(make_docs([f"固有{i}。{passage}" for i in range(3)])).collect()}
    assert len(texts[0].text) > 100 > len(texts[1].text)
