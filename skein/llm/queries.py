"""Queries of the corpus operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from skein.llm import conversation_repair, decontamination, embedding_dedup, language_id, packing, sharding, simhash, source_divergence, source_mix, token_counts, token_files, toxicity, url_filter

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_language_id": language_id.op2_language_id,
    "op3_simhash": simhash.op3_simhash,
    "op4_token_files": token_files.op4_token_files,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_sharding": sharding.op10_sharding,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_source_divergence": source_divergence.op12_source_divergence,
    "op13_source_mix": source_mix.op13_source_mix,
}

ORACLE_SQL: dict[str, str] = {
    "op1_token_counts": token_counts.OP1_SQL,
    "op6_decontamination": decontamination.OP6_SQL,
    "op7_url_filter": url_filter.OP7_SQL,
    "op11_conversation_repair": conversation_repair.OP11_SQL,
    "op12_source_divergence": source_divergence.OP12_SQL,
}
