from __future__ import annotations

import re

from alleleframe.llm import license_scan as L
from alleleframe.llm.license_texts import FULL_TEXTS


def found(docs):
    return sorted((r.doc_id, r.scope, r.line, r.license) for r in L.license_matches(docs).collect())


def test_whole_texts_match_in_any_spelling(make_docs):
    mit, bsd = FULL_TEXTS[0][1], dict(FULL_TEXTS)["BSD-2-Clause"]
    texts = [
        mit,
        "Copyright (c) 2020 Someone\n\n" + mit.upper().replace("SUBLICENSE", "SUB-LICENCE"),
        mit.replace("\n", "\r\n  ").replace('"', "''"),
        mit + " And more.",
        mit[:-40],
        bsd.replace("COPYRIGHT HOLDERS", "copyright owners").replace("COPYRIGHT HOLDER ", "copyright owner "),
    ]
    got = [(i, name) for i, scope, _, name in found(make_docs(texts)) if scope == "text"]
    assert got == [(0, "MIT"), (1, "MIT"), (2, "MIT"), (5, "BSD-2-Clause")]


def test_notices_match_as_lines(make_docs):
    texts = [
        "Some words.\nLicensed under the Apache License, Version 2.0.\nMore words.",
        "Released under the MIT License.",
        "* this work is LICENCED under CC BY-NC 4.0 *",
        "Not licensed under the MIT License.",
        None,
        "",
        "# SPDX-License-Identifier: GPL-3.0",
    ]
    assert found(make_docs(texts)) == [
        (0, "line", 1, "Apache-2.0"),
        (1, "line", 0, "MIT"),
        (2, "line", 0, "CC-BY-NC-4.0"),
        (6, "line", 0, "GPL-3.0"),
    ]


def test_special_rows(make_docs):
    docs = make_docs([(1, "MIT", "s"), (None, "Released under the MIT License.", None)] * 2 + [(2, "x " * 300_000, "s")])
    docs = docs.selectExpr("*", "1 AS license", "2 AS line", "3 AS digest")
    assert found(docs) == [(None, "line", 0, "MIT")] * 2
    assert found(docs.limit(0)) == []


def test_every_known_text_finds_itself(make_docs):
    got = found(make_docs([text for _, text in FULL_TEXTS]))
    assert [(i, n) for i, s, _, n in got if s == "text"] == [(i, n) for i, (n, _) in enumerate(FULL_TEXTS)]


def test_any_copyright_line_is_left_out(make_docs):
    lines = [
        "Copyright (c) Some Company.",
        "Copyright (c) <year> <copyright holders>",
        "Copyright (c) John Doe 2020",
        "Copyright Jane Doe",
        "Copyright: 2020 X",
        "(c) Copyright 2020 X",
        "(C) 2020 X",
        "\u00a9 Jane Doe",
        " * COPYRIGHT 1999-2020 The Authors. All rights reserved.",
        "Copyright The Authors\nCopyright (c) 2021 Others",
    ]
    known = (FULL_TEXTS * 2)[: len(lines)]
    got = found(make_docs([f"{line}\n\n{text}" for line, (_, text) in zip(lines, known, strict=True)]))
    assert [(i, n) for i, s, _, n in got if s == "text"] == [(i, n) for i, (n, _) in enumerate(known)]


def test_wrapped_licence_sentences_stay(make_docs):
    words = [text.split() for _, text in FULL_TEXTS]
    wrapped = [re.sub(r" (copyright\b)", r"\n\1", " ".join(w), flags=re.I) for w in words]
    assert any(line.lower().startswith("copyright") for text in wrapped for line in text.split("\n"))
    got = found(make_docs(wrapped))
    assert [(i, n) for i, s, _, n in got if s == "text"] == [(i, n) for i, (n, _) in enumerate(FULL_TEXTS)]


def test_further_texts_from_a_table(spark, make_docs):
    own = "You may use this for any purpose.\n\n(c) You must retain this list.\n"
    texts = spark.createDataFrame(
        [("Own-1.0", own), ("None-1.0", None), ("Empty-1.0", " .\n")], "license string, text string"
    )
    docs = make_docs(["Copyright Someone\n" + own.upper(), "", None, own.replace("retain", "keep"), FULL_TEXTS[0][1]])
    got = sorted((r.doc_id, r.scope, r.license) for r in L.license_matches(docs, texts).collect())
    assert got == [(0, "text", "Own-1.0"), (4, "text", "MIT")]


def test_plan_has_no_python_and_no_shuffle_of_texts(make_docs):
    plan = L.license_matches(make_docs(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert "BroadcastHashJoin" in plan
