"""Queries and SQL of this subpackage."""

from __future__ import annotations

from . import embedding_dedup, exact_dedup, jaccard, line_dedup, lm, mixing, packing, resampling, secret_scan, suffix_dedup, tokens, toxicity, vector_codes

_QUERIES = {
    "op1_toxicity": (toxicity.op1_toxicity, None),
    "op2_line_dedup": (line_dedup.op2_line_dedup, line_dedup.OP2_SQL),
    "op3_ngram_jaccard": (jaccard.op3_ngram_jaccard, None),
    "op4_token_counts": (tokens.op4_token_counts, None),
    "op5_best_fit_packing": (packing.op5_best_fit_packing, None),
    "op6_exact_dedup": (exact_dedup.op6_exact_dedup, exact_dedup.OP6_SQL),
    "op7_suffix_dedup": (suffix_dedup.op7_suffix_dedup, None),
    "op8_embedding_dedup": (embedding_dedup.op8_embedding_dedup, None),
    "op10_lm_scoring": (lm.op10_lm_scoring, None),
    "op9_source_mixing": (mixing.op9_source_mixing, mixing.OP9_SQL),
    "op11_vector_codes": (vector_codes.op11_vector_codes, vector_codes.OP11_SQL),
    "op12_importance_resampling": (resampling.op12_importance_resampling, None),
    "op13_secret_scan": (secret_scan.op13_secret_scan, secret_scan.OP13_SQL),
}


def queries() -> dict:
    return {k: f for k, (f, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for k, (_, q) in _QUERIES.items() if q}
