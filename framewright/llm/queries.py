"""Queries of the training-data operators, and SQL where SQL can express them."""

from __future__ import annotations

from . import chat, ego_join, kn_quality, mixing, packing, pii, simhash, token_counts, topk_impact, toxicity

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_chat": chat.op2_chat,
    "op3_mixing": mixing.op3_mixing,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_simhash": simhash.op5_simhash,
    "op6_quality": kn_quality.op6_quality,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_ego_join": ego_join.op8_ego_join,
    "op9_topk": topk_impact.op9_topk,
    "op10_packing": packing.op10_packing,
}

ORACLE_SQL = {"op2_chat": chat.SQL, "op3_mixing": mixing.SQL, "op8_ego_join": ego_join.SQL, "op9_topk": topk_impact.SQL}
