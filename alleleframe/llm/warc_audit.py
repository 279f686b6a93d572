"""Merkle fixity audit of web archives that are stored more than once.

A leaf is a record: archive, offset, length and the SHA-256 of its bytes. Nodes
cover fixed ranges of offsets: the lowest ones ``RANGE`` bytes, each level above
``FAN_OUT`` times as much, up to one root per archive. A node's digest is that
of its children's offsets and digests in order, so a node has a bounded number of
children at any size. Replicas are compared from the roots down, and only the
children of nodes that differ are looked at; at the leaves that locates records
that are altered, missing or extra. Record bytes are read once, where they are
stored; everything that is moved has a fixed width.

Nulls: a null url or html counts as empty, a null ``page_id`` is named 0;
such records are dealt out to archives of their own by a digest of url and html. Rows that repeat a page are records of their
own, each with its offset. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from alleleframe.llm.common import staged, table

RANGE = 1 << 16
FAN_OUT = 16
#: Pages per archive file.
PAGES = 1000


def record_head(page_id: Column, url: Column, length: Column) -> Column:
    """Header lines of a response record with ``length`` bytes of content."""
    lines = [
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        page_id.cast("string"),
        F.lit(">\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        length.cast("string"),
        F.lit("\r\n\r\n"),
    ]
    return F.concat(*lines)


def nodes(children: DataFrame, width: int) -> DataFrame:
    """Nodes of ``width`` bytes above ``children`` with archive, offset and digest."""
    part = F.concat_ws(":", F.lpad(F.col("offset").cast("string"), 20, "0"), "digest")
    return (
        children.groupBy("archive", (F.floor(F.col("offset") / width) * width).alias("offset"))
        .agg(F.sha2(F.array_join(F.array_sort(F.collect_list(part)), "\n"), 256).alias("digest"))
        .select("archive", "offset", "digest")
    )


def tree(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """The levels from the leaves up to the roots."""
    sealed = F.sha2(F.concat_ws(":", "offset", "length", "digest"), 256)
    found = [leaves.select("archive", "offset", sealed.alias("digest"))]
    for k in range(levels):
        found.append(nodes(found[-1], RANGE * FAN_OUT**k))
    return found


def _different(one: DataFrame, other: DataFrame) -> DataFrame:
    """archive and offset of nodes that are not the same on both sides."""
    other = other.withColumnRenamed("digest", "other_digest")
    joined = one.join(other, ["archive", "offset"], "full")
    return joined.where(~F.col("digest").eqNullSafe(F.col("other_digest"))).select("archive", "offset")


def _below(level: DataFrame, different: DataFrame, width: int) -> DataFrame:
    """Nodes or leaves inside the ranges of ``width`` bytes that differ."""
    ranges = different.select(F.col("archive").alias("in_archive"), F.col("offset").alias("in_offset"))
    return level.join(
        ranges,
        (F.col("archive") == F.col("in_archive"))
        & (F.floor(F.col("offset") / width) * width == F.col("in_offset")),
        "left_semi",
    )


def audit(one: DataFrame, other: DataFrame) -> DataFrame:
    """Records that differ: archive, offset, status, and length and digest on both sides.

    Both have archive, offset, length, digest; an archive has one record per offset.
    """
    ends = one.agg(F.max("offset")).union(other.agg(F.max("offset"))).agg(F.max("max(offset)"))
    largest = ends.first()[0] or 0
    levels = 1
    while RANGE * FAN_OUT ** (levels - 1) <= largest:
        levels += 1
    trees = [[staged(level, "warc-level") for level in tree(x, levels)[1:]] for x in (one, other)]
    different = _different(trees[0][-1], trees[1][-1])
    for k in range(levels - 1, 0, -1):
        width = RANGE * FAN_OUT**k
        different = _different(
            _below(trees[0][k - 1], different, width), _below(trees[1][k - 1], different, width)
        )
    different = staged(different, "warc-ranges")
    left, right = (_below(x, different, RANGE) for x in (one, other))
    right = right.withColumnsRenamed({"length": "found_length", "digest": "found_digest"})
    joined = left.join(right, ["archive", "offset"], "full")
    status = (
        F.when(F.col("found_digest").isNull(), "missing")
        .when(F.col("digest").isNull(), "extra")
        .otherwise("altered")
    )
    same = F.col("digest").eqNullSafe(F.col("found_digest")) & F.col("length").eqNullSafe(
        F.col("found_length")
    )
    return joined.where(~same).select(
        "archive", "offset", status.alias("status"), "length", "found_length", "digest", "found_digest"
    )


#: Archives that records without an id are dealt out to by a digest of their bytes.
SPARE_ARCHIVES = 1 << 20


def _number(text: Column, modulus: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % modulus


def damaged_replicas(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves of the archives of ``pages``, and of a replica in which some records are damaged.

    By a digest of its id, a page in 97 has its first ``<`` changed in the
    replica, one ends early, one is missing and one has a copy behind the
    archive's last record. Every record of both replicas is written out and
    hashed, in one pass over the pages; where the damage is, only the bytes tell.
    """
    page_id = F.coalesce(F.col("page_id"), F.lit(0)).cast("long")
    url, html = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("url", "html"))
    spare = -1 - _number(F.concat(url, html), SPARE_ARCHIVES)
    archive = F.when(F.col("page_id").isNull(), spare).otherwise(F.floor(page_id / PAGES)).cast("long")
    at = F.instr("html", "<")
    damaged = F.when((F.col("fate") == 3) & (at > 0), F.expr("overlay(html placing '(' from instr(html, '<'))"))
    damaged = damaged.when(F.col("fate") == 5, F.expr("left(html, length(html) div 2)")).otherwise(F.col("html"))
    head = record_head(F.col("page_id"), F.col("url"), F.octet_length("html"))
    records = pages.select(
        page_id.alias("page_id"),
        url.alias("url"),
        html.alias("html"),
        archive.alias("archive"),
        _number(page_id.cast("string"), 97).alias("fate"),
    ).select(
        "archive",
        "page_id",
        "fate",
        F.concat(head, "html", F.lit("\r\n\r\n")).alias("record"),
        F.concat(head, damaged, F.lit("\r\n\r\n")).alias("other"),
    )
    hashed = records.select(
        "archive",
        "page_id",
        "fate",
        *leaf("record", "length", "digest"),
        *leaf("other", "other_length", "other_digest"),
    )
    order = W.partitionBy("archive").orderBy("page_id", "digest")
    placed = staged(
        hashed.withColumn("offset", F.sum("length").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("length"))
        .withColumn("size", F.sum("length").over(W.partitionBy("archive"))),
        "warc-leaves",
    )
    one = placed.select("archive", "offset", "length", "digest")
    kept = placed.where("fate != 7").select(
        "archive", "offset", F.col("other_length").alias("length"), F.col("other_digest").alias("digest")
    )
    extra = placed.where("fate = 11").select(
        "archive", (F.col("size") + F.col("offset")).alias("offset"), "other_length", "other_digest"
    )
    return one, kept.union(extra)


def leaf(record: str, length: str, digest: str) -> list[Column]:
    """Length and digest of a record's bytes: a leaf of a tree."""
    return [F.octet_length(record).cast("long").alias(length), F.sha2(F.col(record), 256).alias(digest)]


def op4_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(*damaged_replicas(table(spark, sf_dir, "pages")))


SQL = {
    "op4_warc_audit": r"""
WITH p AS (SELECT COALESCE(page_id, 0) AS page_id, COALESCE(url, '') AS url, COALESCE(html, '') AS html,
 CAST('0x' || substr(md5(CAST(COALESCE(page_id, 0) AS VARCHAR)), 1, 8) AS BIGINT) % 97 AS fate,
 CASE WHEN page_id IS NULL THEN -1 - CAST('0x' || substr(md5(concat(url, html)), 1, 8) AS BIGINT) % 1048576
  ELSE CAST(floor(page_id / 1000) AS BIGINT) END AS archive FROM pages),
h AS (SELECT *, concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10),
 'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10),
 'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', strlen(html), chr(13), chr(10), chr(13), chr(10)) AS head,
 CASE WHEN fate = 3 AND instr(html, '<') > 0 THEN concat(substr(html, 1, instr(html, '<') - 1), '(',
   substr(html, instr(html, '<') + 1)) WHEN fate = 5 THEN substr(html, 1, length(html) // 2) ELSE html END AS bad FROM p),
r AS (SELECT archive, page_id, fate,
 concat(head, html, chr(13), chr(10), chr(13), chr(10)) AS record,
 concat(head, bad, chr(13), chr(10), chr(13), chr(10)) AS spoiled FROM h),
l AS (SELECT *, strlen(record) AS length, sha256(record) AS digest, strlen(spoiled) AS found_length,
 sha256(spoiled) AS found_digest FROM r),
o AS (SELECT *, CAST(SUM(length) OVER (PARTITION BY archive ORDER BY page_id, digest
  ROWS UNBOUNDED PRECEDING) - length AS BIGINT) AS "offset",
 CAST(SUM(length) OVER (PARTITION BY archive) AS BIGINT) AS size FROM l)
SELECT archive, "offset", 'altered' AS status, length, found_length, digest, found_digest FROM o
 WHERE fate IN (3, 5) AND (digest <> found_digest OR length <> found_length)
UNION ALL SELECT archive, "offset", 'missing', length, NULL, digest, NULL FROM o WHERE fate = 7
UNION ALL SELECT archive, size + "offset", 'extra', NULL, length, NULL, digest FROM o WHERE fate = 11
""",
}
