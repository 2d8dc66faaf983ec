"""The queries of this subpackage by name, and their SQL where SQL can say it."""

from __future__ import annotations

from crateflow.llm import (
    byte_bpe,
    conversation_repair,
    decontaminate,
    divergence,
    exact_dedup,
    near_dedup,
    packing,
    passages,
    preference,
    quality,
    secret_scan,
    token_counts,
    url_filter,
)

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_chat_preference": preference.op4_chat_preference,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_byte_bpe": byte_bpe.op6_byte_bpe,
    "op7_quality_classifier": quality.op7_quality_classifier,
    "op8_near_dedup": near_dedup.op8_near_dedup,
    "op9_substring_dedup": passages.op9_substring_dedup,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_packing": packing.op13_packing,
}

ORACLE = {
    "op2_url_filter": url_filter.ORACLE_SQL,
    "op4_chat_preference": preference.ORACLE_SQL,
    "op8_near_dedup": near_dedup.ORACLE_SQL,
    "op9_substring_dedup": passages.ORACLE_SQL,
    "op10_exact_dedup": exact_dedup.ORACLE_SQL,
    "op11_source_divergence": divergence.ORACLE_SQL,
    "op12_conversation_repair": conversation_repair.ORACLE_SQL,
}
