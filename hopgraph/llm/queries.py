"""Registered queries of the subpackage, with DuckDB SQL where SQL can state the result."""

from __future__ import annotations

from hopgraph.llm import (
    conversations,
    decontaminate,
    exact_dedup,
    html_labeller,
    line_dedup,
    mixing,
    near_dedup,
    quality_classifier,
    quality_rules,
    sharding,
    spelling,
    token_counts,
    toxicity,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_mixing": mixing.op2_mixing,
    "op3_sharding": sharding.op3_sharding,
    "op4_quality_classifier": quality_classifier.op4_quality_classifier,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_decontamination": decontaminate.op6_decontamination,
    "op7_html_extraction": html_labeller.op7_html_extraction,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_spelling": spelling.op11_spelling,
    "op12_conversation_repair": conversations.op12_conversation_repair,
    "op13_exact_dedup": exact_dedup.op13_exact_dedup,
}
ORACLE_SQL = {
    "op1_line_dedup": line_dedup.SQL,
    "op2_mixing": mixing.SQL,
    "op10_quality_rules": quality_rules.SQL,
    "op11_spelling": spelling.SQL,
    "op12_conversation_repair": conversations.SQL,
    "op13_exact_dedup": exact_dedup.SQL,
}
