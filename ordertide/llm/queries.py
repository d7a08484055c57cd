"""Registered queries of the training-data operators and their DuckDB SQL.

Queries without SQL here can't be expressed in it; tests/llm checks those
against brute force, an exact round trip or held-out accuracy.
"""

from __future__ import annotations

from ordertide.llm import (
    op1_mixing,
    op2_html,
    op3_exact_dedup,
    op4_pii,
    op5_packing,
    op6_spotsigs,
    op7_toxicity,
    op8_token_counts,
    op9_near_dedup,
    op10_lm_scoring,
    op11_filter_audit,
    op12_substring_dedup,
    op13_merkle,
)

QUERIES = {
    "op1_mixing": op1_mixing.op1_mixing,
    "op2_html": op2_html.op2_html,
    "op3_exact_dedup": op3_exact_dedup.op3_exact_dedup,
    "op4_pii": op4_pii.op4_pii,
    "op5_packing": op5_packing.op5_packing,
    "op6_spotsigs": op6_spotsigs.op6_spotsigs,
    "op7_toxicity": op7_toxicity.op7_toxicity,
    "op8_token_counts": op8_token_counts.op8_token_counts,
    "op9_near_dedup": op9_near_dedup.op9_near_dedup,
    "op10_lm_scoring": op10_lm_scoring.op10_lm_scoring,
    "op11_filter_audit": op11_filter_audit.op11_filter_audit,
    "op12_substring_dedup": op12_substring_dedup.op12_substring_dedup,
    "op13_merkle": op13_merkle.op13_merkle,
}

ORACLE_SQL = {
    "op1_mixing": op1_mixing.ORACLE,
    "op3_exact_dedup": op3_exact_dedup.ORACLE,
    "op11_filter_audit": op11_filter_audit.ORACLE,
    "op12_substring_dedup": op12_substring_dedup.ORACLE,
    "op13_merkle": op13_merkle.ORACLE,
}
