"""Mix sources to target weights with Pareto order sampling.

Every source gets a target in words: a share of all words by its weight, at most
``MAX_COPIES`` times its own words; what a capped source leaves is shared again
by weight. The words of a source are wanted ``target / words`` times. The whole
part of that number is taken for certain; of the fraction, a sample is drawn.

Pareto order sampling: document i with inclusion probability p_i gets a uniform
number u_i, fixed by its id, and the rank value u/(1-u) / (p/(1-p)). The sample
is the documents with the smallest values, as many as fill the open words of the
source, so its size is fixed up to half a document. A weight column makes the
probabilities unequal inside a source as well.

No source is ordered in one task: rank values are counted in bins, one row per
source and bin, and only the bin that holds the cut is ordered. The result of
all this is one row per source; each document then decides for itself.

Nulls: a null text has no words; a null source is a source of its own, last in
order. In ``op8_pareto_mixing`` the id alone names a document, as in its SQL: rows
without ``doc_id`` share one random number, and rows that repeat a ``doc_id`` are
taken or left together. In ``mix`` an id that several texts share, or none, is
drawn with the hash of the text, so only rows equal in both are taken or left
together. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from alleleframe.llm.common import staged, table, whole_text

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix-1"
#: Rank values are counted in so many bins; the ordered one holds about this fraction of a source.
BINS = 1 << 14


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) fixed by ``key``: 52 bits of a digest, and a half."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sized: DataFrame, weights=WEIGHTS) -> DataFrame:
    """One row per source: mix_source, source_size, target.

    ``sized`` has mix_source and size. Sources in code point order, null last,
    take ``weights`` in turn. Sources are capped in the order of words per
    weight: going through them, a source is capped if its limit is below what
    the words and weights left by the capped ones before it would give it.
    """
    by_source = sized.groupBy("mix_source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on, so one task orders them.
    ordered = by_source.withColumn(
        "place", F.row_number().over(W.orderBy(F.col("mix_source").asc_nulls_last())) - 1
    )
    turn = F.col("place") % len(weights)
    weight = reduce(
        lambda rest, i: F.when(turn == i, F.lit(float(weights[i]))).otherwise(rest),
        range(len(weights)),
        F.lit(float(weights[0])),
    )
    limit = F.col("source_size").cast("double") * float(MAX_COPIES)
    order = W.orderBy(F.col("limit") / F.col("weight"), "place")
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    shared = (
        ordered.withColumns({"weight": weight, "limit": limit})
        .withColumns(
            {
                "open_words": F.sum("source_size").over(whole).cast("double")
                - F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
                "open_weight": F.sum("weight").over(whole)
                - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
                "turn": F.row_number().over(order),
            }
        )
        .withColumn("level", F.col("open_words") / F.col("open_weight"))
        .withColumn("capped", F.col("limit") <= F.col("level") * F.col("weight"))
    )
    free_level = F.min_by(
        F.when(~F.col("capped"), F.col("level")), F.when(~F.col("capped"), F.col("turn"))
    ).over(whole)
    return shared.withColumn("free_level", free_level).select(
        "mix_source",
        "source_size",
        F.when(F.col("capped"), F.col("limit"))
        .otherwise(F.col("free_level") * F.col("weight"))
        .alias("target"),
    )


def _scaled(sized: DataFrame, targets: DataFrame, weighted: bool) -> DataFrame:
    """Targets with ``scale``: wanted copies of a document are scale x weight, at most ``MAX_COPIES``.

    With equal weights that is target / words. With unequal ones, documents at
    the limit are set aside and the rest raised until no further one reaches it.
    """
    plain = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    if not weighted:
        return targets.withColumn("scale", plain)
    current = targets.withColumn("scale", F.lit(0.0))
    limited = -1
    while True:
        at_limit = F.col("scale") * F.col("mix_weight") >= MAX_COPIES
        parts = (
            sized.join(current, sized["mix_source"].eqNullSafe(current["mix_source"]))
            .groupBy(current["mix_source"])
            .agg(
                F.first("source_size").alias("source_size"),
                F.first("target").alias("target"),
                F.sum(F.when(at_limit, F.col("size")).otherwise(0)).alias("full"),
                F.sum(F.when(at_limit, 0.0).otherwise(F.col("size") * F.col("mix_weight"))).alias(
                    "free"
                ),
                F.sum(at_limit.cast("long")).alias("limited"),
            )
        )
        scale = F.when(
            F.col("free") > 0, (F.col("target") - MAX_COPIES * F.col("full")) / F.col("free")
        ).otherwise(float(MAX_COPIES))
        current = staged(parts.withColumn("scale", scale), "mix-scale")
        now = current.agg(F.sum("limited")).first()[0] or 0
        if now == limited:
            return current.select("mix_source", "source_size", "target", "scale")
        limited = now


def _rank(wanted: Column) -> Column:
    """Pareto rank value; null if the fraction of ``wanted`` is zero, so that no sample is drawn."""
    part = wanted - F.floor(wanted)
    u = uniform(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("mix_hash").cast("string")))
    return F.when(part > 0, (u / (1.0 - u)) / (part / (1.0 - part)))


def cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``cut``: (rank value, doc_id, mix_hash) of the last sampled document, null if none."""
    per_source = targets.withColumnsRenamed({"mix_source": "of"})
    ranked = (
        sized.join(per_source, sized["mix_source"].eqNullSafe(per_source["of"]))
        .withColumn("wanted", F.col("scale") * F.col("mix_weight"))
        .withColumn("wanted", F.least("wanted", F.lit(float(MAX_COPIES))))
        .withColumn("rank", _rank(F.col("wanted")))
        .withColumn(
            "bin",
            F.when(
                F.col("rank").isNotNull(),
                F.least(F.floor(F.col("rank") / (F.col("rank") + 1) * BINS), F.lit(BINS - 1)),
            ),
        )
    )
    certain = F.sum(F.floor("wanted") * F.col("size"))
    binned = ranked.groupBy("mix_source", "bin").agg(
        F.sum("size").alias("size"),
        certain.alias("certain"),
        F.first("target").alias("target"),
    )
    along = W.partitionBy("mix_source").orderBy(F.col("bin").asc_nulls_first())
    through = (
        binned.withColumn("open", F.col("target") - F.sum("certain").over(W.partitionBy("mix_source")))
        .where(F.col("bin").isNotNull())
        .withColumn("upto", F.sum("size").over(along))
        .withColumn("before", F.col("upto") - F.col("size"))
    )
    # The last bin that begins within the open words; all before it are taken whole.
    last = through.where("before <= open").groupBy("mix_source").agg(
        F.max_by(F.struct("bin", "before", "open"), "bin").alias("last")
    )
    last = last.select(F.col("mix_source").alias("of"), "last.*").withColumnRenamed("bin", "cut_bin")
    inside = (
        ranked.drop("of")
        .join(last, F.col("mix_source").eqNullSafe(F.col("of")) & (F.col("bin") == F.col("cut_bin")))
        .groupBy("mix_source", "rank", "doc_id", "mix_hash", "before", "open")
        .agg(F.sum("size").alias("size"))
        .withColumn(
            "upto", F.sum("size").over(W.partitionBy("mix_source").orderBy("rank", "doc_id", "mix_hash"))
        )
        .where(F.col("before") + F.col("upto") - F.col("size") / 2 <= F.col("open"))
        .groupBy("mix_source")
        .agg(F.max(F.struct("rank", "doc_id", "mix_hash")).alias("inner"))
    )
    # If the first document of the cut bin is already too much, the cut lies before that bin.
    edge = last.select(
        "of", F.struct((F.col("cut_bin") / (BINS - F.col("cut_bin"))).alias("rank")).alias("edge")
    )
    found = edge.join(
        inside.withColumnRenamed("mix_source", "inner_of"),
        F.col("of").eqNullSafe(F.col("inner_of")),
        "left",
    ).select("of", "inner", "edge.rank")
    found = found.withColumnRenamed("rank", "edge_rank")
    return targets.join(found, F.col("mix_source").eqNullSafe(F.col("of")), "left").drop("of")


def _size_columns(docs: DataFrame, weight: str | None) -> DataFrame:
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("mix_source"),
        F.xxhash64(whole_text()).alias("text_hash"),
        word_count(whole_text()).alias("size"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("mix_weight"),
    )


def shared_ids(docs: DataFrame) -> DataFrame:
    """shared_id: the ids, null among them, of rows with different texts."""
    hashes = docs.select(F.col("doc_id").alias("shared_id"), F.xxhash64(whole_text()).alias("text_hash"))
    ends = hashes.groupBy("shared_id").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high"))
    return ends.where("low != high").select("shared_id")


def with_hashes(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """``rows`` with mix_hash in place of text_hash: null unless ``doc_id`` is one of the shared ids."""
    shared = shared.withColumn("shared", F.lit(True))
    hashed = rows.join(shared, F.col("doc_id").eqNullSafe(F.col("shared_id")), "left")
    hashed = hashed.withColumn("mix_hash", F.when(F.col("shared"), F.col("text_hash")))
    return hashed.drop("shared", "shared_id", "text_hash")


def plan_mix(
    docs: DataFrame, weights=WEIGHTS, weight: str | None = None, shared: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Staged word counts of all documents, and one row per source with its cut.

    Ids in ``shared`` (see ``shared_ids``) are drawn with the hash of their texts.
    """
    sized = _size_columns(docs, weight)
    if shared is None:
        sized = sized.drop("text_hash").withColumn("mix_hash", F.lit(None).cast("long"))
    else:
        sized = with_hashes(sized, shared)
    sized = staged(sized, "mix-sizes")
    targets = staged(source_targets(sized, weights), "mix-targets")
    targets = _scaled(sized, targets, weight is not None)
    return sized, staged(cuts(sized, targets), "mix-cuts")


def with_copies(rows: DataFrame, plan: DataFrame, source: Column, weight: Column) -> DataFrame:
    """``rows`` with mix_copies and the columns of ``plan``; ``rows`` has doc_id and mix_hash."""
    plan = plan.withColumnsRenamed({"mix_source": "plan_source", "scale": "plan_scale"})
    wanted = F.least(F.col("plan_scale") * weight, F.lit(float(MAX_COPIES)))
    rank = _rank(wanted)
    inner = F.col("inner").isNotNull() & (F.struct(rank.alias("rank"), "doc_id", "mix_hash") <= F.col("inner"))
    # Bins before the cut bin are taken whole even if nothing of the cut bin is.
    drawn = rank.isNotNull() & (inner | (rank < F.col("edge_rank")))
    copies = F.floor(wanted) + F.coalesce(drawn, F.lit(False)).cast("long")
    return rows.join(plan, source.eqNullSafe(F.col("plan_source"))).withColumn(
        "mix_copies", copies.cast("long")
    )


def mix(docs: DataFrame, weights=WEIGHTS, weight: str | None = None) -> DataFrame:
    """The mixed documents: every row as often as the mix takes it."""
    shared = staged(shared_ids(docs), "mix-shared-ids")
    _, plan = plan_mix(docs, weights, weight, shared)
    share = F.col(weight).cast("double") if weight else F.lit(1.0)
    plain = docs.select(
        F.struct("*").alias("row"),
        "doc_id",
        F.col("source").cast("string").alias("of_source"),
        share.alias("of_weight"),
        F.xxhash64(whole_text()).alias("text_hash"),
    )
    counted = with_copies(with_hashes(plain, shared), plan, F.col("of_source"), F.col("of_weight"))
    copies = F.explode(F.array_repeat(F.lit(True), F.col("mix_copies").cast("int")))
    return counted.select("row", copies.alias("copy")).select("row.*")


def op8_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document; see the module."""
    sized, plan = plan_mix(table(spark, sf_dir, "documents"))
    counted = with_copies(sized, plan, F.col("mix_source"), F.col("mix_weight"))
    return counted.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("mix_copies")).alias("taken"),
        F.col("mix_copies").alias("copies"),
    )


SQL = {
    "op8_pareto_mixing": r"""
WITH sized AS (
 SELECT doc_id, source, CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
 FROM documents),
by_source AS (SELECT source, SUM(size)::BIGINT AS source_size FROM sized GROUP BY source),
placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM by_source),
weighted AS (SELECT *, CAST([5, 2, 1][1 + place % 3] AS DOUBLE) AS weight,
 3.0::DOUBLE * source_size AS cap FROM placed),
levels AS (SELECT *, ((SUM(source_size) OVER ())::DOUBLE - COALESCE(SUM(cap) OVER w, 0))
  / ((SUM(weight) OVER ()) - COALESCE(SUM(weight) OVER w, 0)) AS level,
 ROW_NUMBER() OVER (ORDER BY cap / weight, place) AS turn FROM weighted
 WINDOW w AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, cap <= level * weight AS capped FROM levels),
targets AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE weight *
  (SELECT arg_min(level, turn) FROM flagged WHERE NOT capped) END AS target FROM flagged),
wanted AS (SELECT s.*, t.source_size, t.target,
  CASE WHEN t.source_size > 0 THEN LEAST(t.target / t.source_size, 3.0) ELSE 0.0 END AS wanted
 FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
drawn AS (SELECT *, wanted - FLOOR(wanted) AS part,
 (CAST(CAST('0x' || substr(md5('mix-1:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE)
  + 0.5) / 4503599627370496.0::DOUBLE AS u FROM wanted),
ranked AS (SELECT *, (u / (1.0 - u)) / NULLIF(part / (1.0 - part), 0) AS rank FROM drawn),
summed AS (SELECT *, SUM(CASE WHEN rank IS NOT NULL THEN size END)
   OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id RANGE UNBOUNDED PRECEDING) AS upto,
  target - SUM(FLOOR(wanted) * size) OVER (PARTITION BY source) AS open FROM ranked)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, copies FROM (
 SELECT *, CAST(FLOOR(wanted) + CASE WHEN rank IS NOT NULL AND upto - size / 2.0::DOUBLE <= open
   THEN 1 ELSE 0 END AS BIGINT) AS copies FROM summed)
""",
}
