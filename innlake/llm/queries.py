"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from innlake.llm import (
    best_fit, cross_parse, hard_negatives, near_dedup, oracles, page_text, piece_codec, pivot_search, ranked_search, suffix_dedup,
    token_files, trie_bpe, vector_dedup, word_dedup,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.query,
    "op2_best_fit_packing": best_fit.query,
    "op3_token_records": token_files.query,
    "op4_minhash_near_dedup": near_dedup.query,
    "op5_substring_dedup": word_dedup.query,
    "op6_vector_near_dedup": vector_dedup.query,
    "op7_pivot_top_k": pivot_search.query,
    "op8_sentencepiece_codec": piece_codec.query,
    "op9_page_text": page_text.query,
    "op10_language_id": cross_parse.query,
    "op11_ranked_search": ranked_search.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_trie_bpe": trie_bpe.query,
}

# The rest is compared with brute force, the tokenizers' own results or held-out labels in tests/llm.
ORACLES = {
    "op1_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op4_minhash_near_dedup": oracles.NEAR_DEDUP,
    "op5_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op6_vector_near_dedup": oracles.VECTOR_DEDUP,
    "op7_pivot_top_k": oracles.TOP_K,
    "op11_ranked_search": oracles.RANKED_SEARCH,
    "op12_hard_negatives": oracles.HARD_NEGATIVES,
}
