from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from alleleframe.llm import minhash_dedup as M
from alleleframe.llm.arrays import shingle_set, word_hashes
from alleleframe.llm.components import components


def word_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, width, percent):
    sets = [word_set(t, width) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            group[root(a)] = root(b)
    least = {}
    for x, (i, _) in enumerate(rows):
        if sets[x] and i is not None:
            least[root(x)] = min(i, least.get(root(x), i))
    return [(i, len(sets[x]), least.get(root(x)) if sets[x] else i) for x, (i, _) in enumerate(rows)]


def check(make_docs, rows, width=3, percent=85):
    found = M.near_groups(make_docs([(i, t, "s") for i, t in rows]), width, percent)
    got = sorted(
        ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=repr
    )
    assert got == sorted(((i, n, c, i == c) for i, n, c in brute(rows, width, percent)), key=repr)


def varied(seed, groups=12, copies=8):
    """Groups of texts in which some words are replaced, from hardly any to many."""
    draw = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{draw.randrange(5000)}" for _ in range(draw.choice([4, 12, 80, 300]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(draw.randrange(0, 1 + len(base) // 25)):
                words[draw.randrange(len(words))] = f"x{draw.randrange(5000)}"
            rows.append(" ".join(words))
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(make_docs, width, percent):
    check(make_docs, varied(width), width, percent)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None), (2, ""), (3, " \t\n")],
        [(1, "a"), (2, "A"), (3, "a b"), (4, "a  B"), (5, "b a")],
        [(4, "a b c d"), (4, "a b c d"), (9, "a B c\nd")],
        [(None, "a b c"), (3, "a b c"), (None, "only one")],
    ],
)
def test_special_rows(make_docs, rows):
    check(make_docs, rows)


def test_repeated_words_and_long_texts(make_docs):
    long = " ".join(f"w{i}" for i in range(120_000))
    check(make_docs, [(1, long), (2, long + " end"), (3, "the " * 50_000), (4, "The the THE the")])


def test_open_buckets_are_compared_in_blocks(make_docs, monkeypatch):
    """A chain: neighbours are similar, the ends are not, and blocks hold few of them."""
    monkeypatch.setattr(M, "BLOCK", 3)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 200])) for i in range(40)]
    check(make_docs, rows)


def test_rows_stay_whole(make_docs):
    text = " ".join(f"w{i}" for i in range(50))
    docs = make_docs([(2, text, "s"), (1, text + " more", "s"), (3, None, "s")])
    docs = docs.selectExpr("*", "0 AS component_id", "1 AS row")
    rest = M.without_near_copies(docs)
    assert rest.columns == docs.columns
    assert sorted(r.doc_id for r in rest.collect()) == [1, 3]


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 8), (3, 1), (7, 9), (20, 21)] + [(i, i + 1) for i in range(100, 160)]
    found = components(spark.createDataFrame(links, "node long, other long"))
    got = {r.node: r.component for r in found.collect()}
    want = {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20} | {i: 100 for i in range(100, 161)}
    assert got == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "node long, other long")).collect() == []


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    from alleleframe.llm import arrays

    texts = [b"", b"one two", b"  three\tone ", b"x" * 50, b"a b c d e f g h i j k l m n o p"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    whole = word_hashes(data, offsets)
    monkeypatch.setattr(arrays, "CHUNK", 5)
    parts = word_hashes(data, offsets)
    assert whole[0].tolist() == parts[0].tolist()
    assert whole[1].tolist() == parts[1].tolist() == np.cumsum([0] + [len(t.split()) for t in texts]).tolist()
    assert len(shingle_set(whole[0][:2], 3)) == 1


def test_one_row_of_each_component_stays_whatever_the_ids(make_docs):
    def text(n, end=""):
        return " ".join(f"w{n}x{i}" for i in range(60)) + end

    rows = [(1, text(1), "s")] * 2 + [(1, text(1, " end"), "s"), (2, text(1, " fin"), "s")]
    rows += [(None, text(2), "s"), (None, text(2, " end"), "s"), (None, text(2), "t"), (None, text(3), "s")]
    rows += [(1, text(4), "s"), (None, None, "s"), (5, "", "s")]
    rest = M.without_near_copies(make_docs(rows)).collect()
    assert sorted((r.text or "")[:4] for r in rest) == ["", "", "w1x0", "w2x0", "w3x0", "w4x0"]
    again = M.without_near_copies(make_docs(rows[::-1]).repartition(5)).collect()
    assert sorted(rest, key=repr) == sorted(again, key=repr)


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_with_equal_polynomial_hashes_are_not_linked(make_docs, size):
    first = "".join("ab"[bin(i).count("1") & 1] for i in range(size))
    check(make_docs, [(1, first), (2, first.translate(str.maketrans("ab", "ba"))), (3, first.upper())])


def test_rows_that_repeat_id_and_text_meet_once(make_docs, monkeypatch):
    """However often a row is repeated, one comparison holds one row per class."""
    base = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(base))] * 3000 + [(5, " ".join([*base[:-1], "x"]))]
    monkeypatch.setattr(M, "common_sizes", _bounded(M.common_sizes))
    found = M.near_groups(make_docs([(i, t, "s") for i, t in rows]), 3, 85).collect()
    assert len(found) == 3001 and {r.component_id for r in found} == {5}


def _bounded(plain):
    def sizes(sets, n):
        assert len(sets) <= 2 * 256
        return plain(sets, n)

    return sizes
