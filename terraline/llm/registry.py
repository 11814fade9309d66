"""Queries of the training-data operators."""

from __future__ import annotations

import corpus_pipeline
from terraline.llm import bpe, chat, decontam, langid, prefixtrie, sadedup, sharding, simhash, telephony, tokencount, tokenfile, topk, whitening


def queries() -> dict:
    return {
        "op1_language_id": langid.op1_language_id,
        "op2_chat": chat.op2_chat,
        "op3_token_counts": tokencount.op3_token_counts,
        "op4_byte_bpe": bpe.op4_byte_bpe,
        "op5_simhash": simhash.op5_simhash,
        "op6_sharding": sharding.op6_sharding,
        "op7_token_file": tokenfile.op7_token_file,
        "op8_decontamination": decontam.op8_decontamination,
        "op9_telephony": telephony.op9_telephony,
        "op10_suffix_array_dedup": sadedup.op10_suffix_array_dedup,
        "op11_prefix_trie": prefixtrie.op11_prefix_trie,
        "op12_whitening": whitening.op12_whitening,
        "op13_top_k": topk.op13_top_k,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    found = {"op2_chat": chat.ORACLE_SQL, "op8_decontamination": decontam.ORACLE_SQL, "op11_prefix_trie": prefixtrie.ORACLE_SQL, "op13_top_k": topk.ORACLE_SQL}
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
