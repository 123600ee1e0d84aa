"""The queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from tidewater.llm import (chat, exact_dedup, filter_audit, language, mixing, near_dedup, packing, pii, prefix_trie, quality_model, quality_rules,
                           token_files, word_model)

QUERIES = {
    "op1_near_dedup": near_dedup.op1_near_dedup,
    "op2_language_id": language.op2_language_id,
    "op3_chat_format": chat.op3_chat_format,
    "op4_pii": pii.op4_pii,
    "op5_word_model": word_model.op5_word_model,
    "op6_quality_model": quality_model.op6_quality_model,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_pack": packing.op8_pack,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_token_files": token_files.op13_token_files,
}

ORACLE = {
    "op3_chat_format": chat.SQL,
    "op7_mix_sources": mixing.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op11_filter_audit": filter_audit.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}
