"""Queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from alleleframe.llm import (
    bpe,
    conversation_repair,
    embedding_dedup,
    exact_dedup,
    language_id,
    lexical_search,
    license_scan,
    line_dedup,
    minhash_dedup,
    mixing,
    quality,
    secrets,
    warc_audit,
)


def all_queries():
    return {
        "op1_exact_dedup": exact_dedup.op1_exact_dedup,
        "op2_embedding_dedup": embedding_dedup.op2_embedding_dedup,
        "op3_line_dedup": line_dedup.op3_line_dedup,
        "op4_warc_audit": warc_audit.op4_warc_audit,
        "op5_minhash_dedup": minhash_dedup.op5_minhash_dedup,
        "op6_license_scan": license_scan.op6_license_scan,
        "op7_byte_bpe": bpe.op7_byte_bpe,
        "op8_pareto_mixing": mixing.op8_pareto_mixing,
        "op9_quality_classifier": quality.op9_quality_classifier,
        "op10_secret_scan": secrets.op10_secret_scan,
        "op11_lexical_search": lexical_search.op11_lexical_search,
        "op12_conversation_repair": conversation_repair.op12_conversation_repair,
        "op13_language_id": language_id.op13_language_id,
    }


def all_sql():
    return {**exact_dedup.SQL, **line_dedup.SQL, **license_scan.SQL, **warc_audit.SQL, **mixing.SQL, **lexical_search.SQL, **conversation_repair.SQL}
