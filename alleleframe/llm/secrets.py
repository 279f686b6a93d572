"""Secrets in texts: fixed patterns, and a battery of randomness tests. Spark SQL functions only.

Base kinds are matched by pattern, leftmost and without overlap: ``assign``,
``access`` and ``hex``. The battery adds the kind ``random``. Its candidates are
runs of 16 or more base64 characters with letters and digits. The narrowest
encoding that has all characters of a run is inferred (hex, base32, alphabets
of 36, 62 and 64), and three tests ask whether the run could be uniformly random
in that encoding:

* chi-squared of the character counts against equal counts, with the exact mean
  and variance for the length,
* number of runs above and below the middle of the alphabet (Wald-Wolfowitz),
* correlation of each character's place in the alphabet with the next one's.

The smallest of the three p-values, times three, is the run's p-value. Within
each encoding and each doubling of length, Benjamini-Hochberg at ``FDR`` rejects
the runs that are not random, over all documents; so of the runs set aside as
ordinary text at most that share is expected to be random ones. Runs that stand
and lie in no base span are reported. P-values are rounded up to eighths of a
power of two and counted per grid point, which keeps the control and needs
no global order of all runs: the driver reads one row per encoding and length
class, less than 200 whatever the data.

Nulls: a null text is empty and has no spans; ``doc_id`` is only carried along,
also null or repeated. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from alleleframe.llm.common import staged, table, whole_text

ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
LEAST_VALUE = 6
#: Longest runs of these characters; a match of the shorter pattern that is too short has no longer part.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
KINDS = ("assign", "access", "hex", "random")
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from narrow to wide: name and alphabet.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef"),
    ("HEX", _DIGITS + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("lower36", _DIGITS + _LOWER),
    ("upper36", _DIGITS + _UPPER),
    ("base62", _DIGITS + _UPPER + _LOWER),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/-_"),
)
FDR = 0.05
#: Matches of a text whose offsets are summed one by one.
TOGETHER = 128
_SPAN = "array<struct<start:int,end:int,value:string>>"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """start, end and ``value`` (of ``group``) of all matches, from the texts between them."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(whole, F.length).alias("size"),
        value.alias("value"),
    )
    # A lambda's argument is evaluated once, unlike a repeated expression.
    found = F.transform(F.array(parts), _placed)[0]
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def _placed(parts: Column) -> Column:
    """Spans of all matches; ``parts`` has the gap before each match, its size and its value.

    Offsets are sums over all parts before. They are taken within blocks of
    ``TOGETHER`` parts and over the blocks, so that a text with very many matches
    costs little more for each of them than a text with few.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size(parts) - 1, F.lit(0)), F.lit(TOGETHER))
    blocks = F.transform(starts, lambda i: _block(F.slice(parts, i + 1, TOGETHER)))

    def joined(blocks):
        def moved(block, i):
            before = F.aggregate(F.slice(blocks, 1, i), F.lit(0), lambda total, b: total + b["at"])
            return F.transform(F.array(before), lambda by: _shifted(block["found"], by))[0]

        return F.flatten(F.transform(blocks, moved))

    return F.transform(F.array(blocks), joined)[0]


def _shifted(spans: Column, by: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            (s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["value"].alias("value")
        ),
    )


def _block(parts: Column) -> Column:
    """at (the length of all parts) and found (their spans, from the first part's start)."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(state, part):
        start = state["at"] + part["gap"]
        end = start + F.coalesce(part["size"], F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), part["value"].alias("value"))
        more = F.when(part["size"].isNull(), state["found"]).otherwise(
            F.concat(state["found"], F.array(span))
        )
        return F.struct(end.alias("at"), more.alias("found"))

    return F.aggregate(parts, begin, step)


def _tail(z: Column) -> Column:
    """Probability that a normal value exceeds ``z`` >= 0, to 1e-7 (Abramowitz and Stegun 7.1.26)."""
    x = z / 2**0.5
    t = 1 / (1 + 0.3275911 * x)
    series = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    total = reduce(lambda rest, c: (rest + c) * t, reversed(series), F.lit(0.0))
    return total * F.exp(-x * x) / 2


def _upper(z: Column) -> Column:
    return F.when(z >= 0, _tail(z)).otherwise(1 - _tail(-z))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def battery(value: Column) -> Column:
    """encoding, length and p of a candidate run."""
    core = F.rtrim(value, F.lit("="))
    encoding = F.coalesce(
        *[F.when(core.rlike(f"^[{a}]+$"), F.lit(i)) for i, (_, a) in enumerate(ENCODINGS[:-1])],
        F.lit(len(ENCODINGS) - 1),
    )
    alphabet = F.element_at(F.array(*[F.lit(a) for _, a in ENCODINGS]), encoding + 1)
    letters = F.filter(F.split(core, ""), lambda c: c != "")
    row = F.struct(
        encoding.alias("encoding"),
        F.length(alphabet).cast("double").alias("k"),
        F.length(core).cast("double").alias("n"),
        letters.alias("letters"),
        F.transform(letters, lambda c: (F.instr(alphabet, c) - 1).cast("double")).alias("codes"),
    )
    # A lambda's argument is evaluated once, unlike a repeated expression.
    return F.transform(F.array(row), _tests)[0]


def _tests(run: Column) -> Column:
    n, k, letters, codes = run["n"], run["k"], run["letters"], run["codes"]
    squares = _total(
        F.transform(
            F.array_distinct(letters),
            lambda c: F.pow(F.size(F.filter(letters, lambda d: d == c)).cast("double"), F.lit(2.0)),
        )
    )
    chi = k / n * squares - n
    p_chi = _upper((chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))

    high = F.size(F.filter(codes, lambda c: c >= k / 2)).cast("double")
    pairs = F.zip_with(
        F.slice(codes, 1, F.size(codes) - 1),
        F.slice(codes, 2, F.size(codes) - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    changes = F.size(F.filter(pairs, lambda p: (p["a"] >= k / 2) != (p["b"] >= k / 2)))
    middle = 2 * high * (n - high) / n
    spread = middle * (middle - 1) / (n - 1)
    # All characters in one half: as unlikely as that is at this length.
    p_runs = F.when(spread > 0, 2 * _tail(F.abs(changes - middle) / F.sqrt(spread))).otherwise(
        F.pow(F.lit(2.0), 1 - n)
    )

    mean = _total(codes) / n
    variance = _total(F.transform(codes, lambda c: (c - mean) * (c - mean)))
    together = _total(F.transform(pairs, lambda p: (p["a"] - mean) * (p["b"] - mean)))
    p_serial = F.when(
        variance > 0, 2 * _tail(F.abs(together / variance + 1 / n) * F.sqrt(n))
    ).otherwise(0.0)

    p = F.least(F.lit(1.0), 3 * F.least(p_chi, p_runs, p_serial))
    # p is rounded up to 2 ** (-grid / 8).
    grid = F.floor(-8 * F.log2(F.greatest(p, F.lit(1e-30)))).cast("int")
    length = F.floor(F.log2(n)).cast("int")
    return F.struct(run["encoding"].alias("encoding"), length.alias("length"), grid.alias("grid"))


def scanned(docs: DataFrame) -> DataFrame:
    """row (the columns of ``docs`` but text), base (start, kind, end) and runs of every document."""
    text = F.col("text")
    some = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), whole_text().alias("text"))

    def plain(found, kind):
        return F.transform(
            found,
            lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")),
        )

    assign = F.filter(
        matches(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= LEAST_VALUE
    )
    base = F.concat(plain(assign, 0), plain(matches(text, ACCESS), 1), plain(matches(text, HEX), 2))
    runs = F.filter(
        matches(text, CANDIDATE), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
    )
    tested = F.transform(
        runs,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), battery(s["value"]).alias("test")
        ),
    )
    return some.select("row", F.array_sort(base).alias("base"), tested.alias("runs"))


def rejection_levels(scan: DataFrame, fdr: float = FDR) -> DataFrame:
    """encoding, length, level: runs of that class with a grid point of ``level`` or more are rejected."""
    points = (
        scan.select(F.explode("runs.test").alias("test"))
        .groupBy("test.encoding", "test.length", "test.grid")
        .agg(F.count("*").alias("n"))
    )
    classes = W.partitionBy("encoding", "length")
    return (
        points.withColumn("upto", F.sum("n").over(classes.orderBy(F.desc("grid"))))
        .withColumn("all", F.sum("n").over(classes))
        .where(F.pow(F.lit(2.0), -F.col("grid") / 8) <= fdr * F.col("upto") / F.col("all"))
        .groupBy("encoding", "length")
        .agg(F.min("grid").alias("level"))
    )


def secret_spans(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """row (the columns of ``docs`` but text), base and spans: arrays of (start, kind, end) in order."""
    scan = staged(scanned(docs), "secret-scan")
    levels = rejection_levels(scan, fdr).collect()  # at most one row per encoding and length class

    def stands(run):
        rejected = F.lit(False)
        for row in levels:
            rejected = rejected | (
                (run["test"]["encoding"] == row["encoding"])
                & (run["test"]["length"] == row["length"])
                & (run["test"]["grid"] >= row["level"])
            )
        inside = F.exists(
            F.col("base"), lambda b: (b["start"] <= run["start"]) & (run["end"] <= b["end"])
        )
        return ~rejected & ~inside

    added = F.transform(
        F.filter(F.col("runs"), stands),
        lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")),
    )
    return scan.select("row", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def _named(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])),
        ",",
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(_named(F.col("base")), 256).alias("base_sha256"),
        _named(F.col("spans")).alias("spans"),
    )
