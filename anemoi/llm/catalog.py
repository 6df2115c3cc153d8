"""Queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from anemoi.llm import (
    collocations, config_packing, conversation_repair, decontaminate, line_dedup, mixing, near_dup, packing, pii, quality_rules, sharding,
    substring_dedup, token_counts,
)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_mixing": mixing.op3_mixing,
    "op4_sharding": sharding.op4_sharding,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_decontamination": decontaminate.op6_decontamination,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_near_dup": near_dup.op8_near_dup,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_packing": packing.op10_packing,
    "op11_best_fit_packing": config_packing.op11_best_fit_packing,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_collocations": collocations.op13_collocations,
}

ORACLE_SQL = {
    "op3_mixing": mixing.ORACLE,
    "op4_sharding": sharding.ORACLE,
    "op5_quality_rules": quality_rules.ORACLE,
    "op6_decontamination": decontaminate.ORACLE,
    "op7_line_dedup": line_dedup.ORACLE,
    "op8_near_dup": near_dup.ORACLE,
    "op9_substring_dedup": substring_dedup.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
