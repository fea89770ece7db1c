"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from entityframe.llm import chat, credentials, exact_dedup, hard_negatives, langid, line_dedup, merkle, mixing, ngram_join, packing, pii, topk, toxicity

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_exact_top_k": topk.op3_exact_top_k,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_chat_windows": chat.op6_chat_windows,
    "op7_mixing": mixing.op7_mixing,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_language_id": langid.op9_language_id,
    "op10_pii": pii.op10_pii,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_credential_links": credentials.op12_credential_links,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

SQL = {
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op3_exact_top_k": topk.OP3_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op8_exact_dedup": exact_dedup.OP8_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op12_credential_links": credentials.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
