"""The queries of this package, one for each operator, and their SQL."""

from __future__ import annotations

from pairloom.llm import chat, decontaminate, language, mixing, quality_model, quality_rules, simhash, substrings, token_counts, tokens

QUERIES = {
    "op1_mix_sources": mixing.query,
    "op2_quality_model": quality_model.query,
    "op3_simhash": simhash.query,
    "op4_decontaminate": decontaminate.query,
    "op5_chat": chat.query,
    "op6_token_ids": tokens.query,
    "op7_quality_rules": quality_rules.query,
    "op8_substrings": substrings.query,
    "op9_language": language.query,
    "op10_token_counts": token_counts.query,
}
ORACLE_SQL = {
    "op1_mix_sources": mixing.ORACLE,
    "op3_simhash": simhash.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
    "op5_chat": chat.ORACLE,
    "op8_substrings": substrings.ORACLE,
}
