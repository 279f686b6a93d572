from __future__ import annotations

import random

import pytest

from alleleframe.llm import warc_audit as A

FIELDS = "archive long, offset long, length long, digest string"


def leaves(seed, archives=4, records=300):
    draw, rows = random.Random(seed), []
    for archive in range(archives):
        offset = 0
        for _ in range(records):
            length = draw.randint(200, 9000)
            rows.append((archive, offset, length, f"{draw.getrandbits(64):016x}"))
            offset += length
    return rows


def located(spark, one, other):
    found = A.audit(spark.createDataFrame(one, FIELDS), spark.createDataFrame(other, FIELDS))
    return sorted((r.archive, r.offset, r.status) for r in found.collect())


def test_equal_replicas_differ_nowhere(spark):
    rows = leaves(1)
    assert located(spark, rows, rows[::-1]) == []


def test_damage_is_located(spark):
    rows = leaves(2)
    other = list(rows)
    other[5] = (*rows[5][:3], "changed")
    other[400] = (*rows[400][:2], 1, rows[400][3])
    del other[700]
    other.append((3, 10_000_000, 9, "more"))
    want = [(*rows[5][:2], "altered"), (*rows[400][:2], "altered"), (*rows[700][:2], "missing"), (3, 10_000_000, "extra")]
    assert located(spark, rows, other) == sorted(want)


def test_a_whole_archive_is_missing(spark):
    rows = leaves(3, 2, 20)
    found = located(spark, rows, [r for r in rows if r[0] != 1])
    assert found == [(*r[:2], "missing") for r in rows if r[0] == 1]


@pytest.mark.parametrize("one, other", [([], []), ([(0, 0, 1, "a")], []), ([], [(0, 0, 1, "a")])])
def test_empty_replicas(spark, one, other):
    assert len(located(spark, one, other)) == len(one) + len(other)


def test_only_branches_that_differ_are_descended(spark):
    rows = leaves(4)
    changed = [(*rows[0][:3], "x"), *rows[1:]]
    one, other = (A.tree(spark.createDataFrame(x, FIELDS), 3) for x in (rows, changed))
    roots = A._different(one[3], other[3])
    assert [r.archive for r in roots.collect()] == [0]
    below = A._below(one[1], A._different(one[2], other[2]), A.RANGE * A.FAN_OUT)
    assert below.count() <= A.FAN_OUT


def test_pages_with_nulls_and_repeats(spark, small_table):
    rows = [(None, None, None), (3, "u", "<p>x"), (3, "u", "<p>x"), (4, "ü", "<" * 100_000), (5, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS archive", "2 AS fate")
    one, other = A.damaged_replicas(pages)
    assert one.count() == len(rows)
    spans = sorted((r.archive, r.offset, r.length) for r in one.collect())
    assert len({archive for archive, *_ in spans}) == 2  # the record without an id is apart
    for archive in {archive for archive, *_ in spans}:
        inside = [(a, n) for x, a, n in spans if x == archive]
        assert inside[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in zip(inside, inside[1:], strict=False))
    assert A.op4_warc_audit(spark, small_table(pages=pages)).count() == A.audit(one, other).count()
    assert A.audit(*A.damaged_replicas(pages.limit(0))).collect() == []


def test_records_without_an_id_are_spread_over_archives(spark, small_table):
    rows = [(None, f"u{i}", "<p>" + "x" * i) for i in range(300)] + [(1, "long", "<b>" + "y" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    one, other = A.damaged_replicas(pages)
    assert one.select("archive").distinct().count() > 290
    assert one.count() == 301


def test_damage_is_found_from_bytes_alone(spark, monkeypatch):
    """Whatever the damage is, the second replica's leaves come from its own records."""
    rows = [(i, "u", f"<p>{i}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    one, other = A.damaged_replicas(pages)
    joined = one.join(other.withColumnsRenamed({"digest": "d", "length": "n"}), ["archive", "offset"])
    changed = joined.where("digest != d OR length != n").count()
    missing = 400 - joined.count()
    found = A.audit(one, other).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in found if r.status != "extra"} == {"altered": changed, "missing": missing}
