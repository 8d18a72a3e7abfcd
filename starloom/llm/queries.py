"""Registered queries of the subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from starloom.llm import (
    bpe,
    chat,
    decontaminate,
    fill_middle,
    jaccard_join,
    language_id,
    quality,
    shards,
    token_counts,
    token_store,
    toxicity,
    url_filter,
    whiten,
)

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_language_id": language_id.op2_language_id,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_token_store": token_store.op8_token_store,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_chat_format": chat.op10_chat_format,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_whitening": whiten.op12_whitening,
    "op13_sharding": shards.op13_sharding,
}

SQL = {
    "op4_decontamination": decontaminate.SQL,
    "op6_quality_rules": quality.SQL,
    "op10_chat_format": chat.SQL,
    "op11_fill_middle": fill_middle.SQL,
    "op13_sharding": shards.SQL,
}
