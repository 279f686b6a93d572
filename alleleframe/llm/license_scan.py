"""Licence texts by canonical digest. Spark SQL functions only.

A text is brought to a canonical form: A-Z in lower case, copyright lines gone,
equivalent spellings made one, punctuation and white space as one space. Its
digest is hash-joined to the digests of known licence texts. Whole documents are
looked up among the licence texts, and their lines among the sentences that name
a licence. The known digests come from a fixed list, so Spark sends that side to
every task and no text is shuffled. A table of further licence texts may be given;
it is joined in the same way, at any size.

A copyright line begins, after comment marks, with the word or its sign, with or
without a year; lines of a licence that begin so ("copyright notice") stay.

The result has a row per match: doc_id, scope (``text`` or ``line``), line
(number from 0, null for a text), license, digest.

Nulls: a null or empty text matches nothing; ``doc_id`` is only carried along,
also null or repeated (each row gives its own matches). An empty table gives an
empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alleleframe.llm.common import ascii_lower, table, whole_text
from alleleframe.llm.license_texts import FULL_TEXTS, SPELLINGS, notices

#: A line of a licence's own sentences that happens to begin with the word; a mark keeps it.
LICENCE_WORDS = (
    r"(?m)^([ \t#*/;-]*)(copyright(,|[ \t]+(notices?|holders?|owners?|ownership|owned|licen[cs]es?|laws?|"
    r"interests?|statements?|disclaimer|permission|protection|treaty|and|or|in|on|for|is|by law|"
    r"the (software|program|work))\b))"
)
COPYRIGHT_LINE = r"(?m)^[ \t#*/;-]*(copyright\b|\(c\) *(copyright\b|[0-9])|©|all rights reserved)[^\n]*$"


def canonical(text: Column) -> Column:
    """Canonical form, line by line: words joined by one space, lines as they were."""
    marked = F.regexp_replace(ascii_lower(text), LICENCE_WORDS, "$1\u0001$2")
    plain = F.regexp_replace(marked, COPYRIGHT_LINE, "")
    for one, other in SPELLINGS:
        plain = F.replace(plain, F.lit(one), F.lit(other))
    return F.regexp_replace(plain, r"[^\p{L}\p{N}\n]+", " ")


def _digest(form: Column) -> Column:
    return F.sha2(F.btrim(F.regexp_replace(form, r"[ \n]+", " ")), 256)


def known(spark: SparkSession, texts: DataFrame | None = None) -> DataFrame:
    """known_scope, license, known_digest of all known texts.

    ``texts`` adds whole texts with columns license and text, such as a table of
    the long licences; rows without a text or with an empty one add nothing.
    """
    rows = [("text", *x) for x in FULL_TEXTS] + [("line", *x) for x in notices()]
    entries = F.from_json(F.lit(json.dumps(rows)), "array<array<string>>")
    listed = spark.range(1).select(F.explode(entries).alias("entry"))
    listed = listed.selectExpr("entry[0] AS known_scope", "entry[1] AS license", "entry[2] AS text")
    if texts is not None:
        more = texts.where(canonical(F.col("text")).rlike(r"[^ \n]"))
        listed = listed.unionByName(more.select(F.lit("text").alias("known_scope"), "license", "text"))
    return listed.select("known_scope", "license", _digest(canonical(F.col("text"))).alias("known_digest")).distinct()


def license_matches(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    form = docs.select("doc_id", canonical(whole_text()).alias("form"))
    lines = F.transform(
        F.split("form", "\n", -1),
        lambda line, i: F.struct(F.lit("line").alias("scope"), i.alias("line"), _digest(line).alias("digest")),
    )
    whole = F.struct(
        F.lit("text").alias("scope"), F.lit(None).cast("int").alias("line"), _digest(F.col("form")).alias("digest")
    )
    units = form.select("doc_id", F.explode(F.concat(F.array(whole), lines)).alias("unit")).select("doc_id", "unit.*")
    listed = known(docs.sparkSession, texts)
    return units.join(
        listed,
        (F.col("digest") == F.col("known_digest")) & (F.col("scope") == F.col("known_scope")),
    ).select("doc_id", "scope", "line", "license", "digest")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql() -> str:
    """DuckDB SQL with the same steps; RE2 knows the same patterns."""

    def form(text: str) -> str:
        lower = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        marked = f"regexp_replace({lower}, {_quoted(LICENCE_WORDS)}, '\\1' || chr(1) || '\\2', 'g')"
        plain = f"regexp_replace({marked}, {_quoted(COPYRIGHT_LINE)}, '', 'g')"
        for one, other in SPELLINGS:
            plain = f"replace({plain}, {_quoted(one)}, {_quoted(other)})"
        return rf"regexp_replace({plain}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"

    def digest(text: str) -> str:
        return rf"sha256(trim(regexp_replace({text}, '[ \n]+', ' ', 'g'), ' '))"

    rows = [("text", *x) for x in FULL_TEXTS] + [("line", *x) for x in notices()]
    values = ",\n".join(f"({_quoted(a)}, {_quoted(b)}, {_quoted(c)})" for a, b, c in rows)
    return f"""
WITH listed(scope, license, text) AS (VALUES {values}),
known AS (SELECT DISTINCT scope, license, {digest(form("text"))} AS digest FROM listed),
forms AS (SELECT doc_id, {form("COALESCE(text, '')")} AS form FROM documents),
split_lines AS (SELECT doc_id, string_split(form, chr(10)) AS l FROM forms),
lines AS (SELECT doc_id, unnest(l) AS form, unnest(range(len(l))) AS line FROM split_lines),
units AS (SELECT doc_id, 'text' AS scope, NULL::INT AS line, {digest("form")} AS digest FROM forms
 UNION ALL SELECT doc_id, 'line', line::INT, {digest("form")} FROM lines)
SELECT doc_id, scope, line, license, digest FROM units JOIN known USING (scope, digest)
"""


SQL = {"op6_license_scan": _sql()}
