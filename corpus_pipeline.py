"""A training corpus from raw documents: filter, deduplicate, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. Stage results are written as Parquet to the shared folder and read again,
so a lost executor costs at most the work of one stage.

1. quality: documents with a classifier score below 0.7 go.
2. exact_dedup: of equal texts the largest doc_id stays.
3. near_dedup: of documents linked by 5-word shingles (similarity 0.8) the
   smallest doc_id stays.
4. mix: sources are weighed 5, 2, 1; rows repeat as often as the mix takes them.
5. tokens: byte-level BPE ids of every row, decoded again as a check.

All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from alleleframe.llm import bpe, exact_dedup, minhash_dedup, mixing, quality
from alleleframe.llm.common import staged, table

#: Pre-tokens of a block of the last stage. Smaller blocks than the operator's own need more disk and
#: less memory, which workers that served the earlier stages have less of.
TOKEN_BLOCK = 1 << 20


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.without_rejected(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.without_near_copies(docs, width=5, percent=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids: one row per row of the mix."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, path, with_ids=True, block_size=TOKEN_BLOCK)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mix", mix_stage),
    ("tokens", token_stage),
]

#: Signatures, learned scores and BPE have no SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
