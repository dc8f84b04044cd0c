"""Queries of this package by name, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from bourse.llm import (byte_bpe, lm_scoring, mixing, near_dedup, prefix_trie, quality_rules, suffix_dedup, token_files, topk_search, toxicity, url_filter,
                       vector_codes, weighted_fingerprint)

QUERIES = {
    "op1_minhash_near_dedup": near_dedup.query,
    "op2_url_filter": url_filter.query,
    "op3_suffix_array_dedup": suffix_dedup.query,
    "op4_lm_scoring": lm_scoring.query,
    "op5_exact_topk": topk_search.query,
    "op6_toxicity": toxicity.query,
    "op7_quality_rules": quality_rules.query,
    "op8_token_files": token_files.query,
    "op9_byte_bpe": byte_bpe.query,
    "op10_mixing": mixing.query,
    "op11_weighted_fingerprint": weighted_fingerprint.query,
    "op12_vector_codes": vector_codes.query,
    "op13_prefix_trie": prefix_trie.query,
}
SQL = {
    "op5_exact_topk": topk_search.SQL,
    "op7_quality_rules": quality_rules.SQL,
    "op12_vector_codes": vector_codes.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
