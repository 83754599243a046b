"""The queries of the training-data operators, whole tables with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from . import budget_mix, byte_bpe, cotrain, crf_toxicity, fertility, line_dedup, mtree, shard_flow, simhash_cover, suffix_dedup

QUERIES = {
    "op1_reshard_flow": shard_flow.op1_reshard_flow,
    "op2_cotrain": cotrain.op2_cotrain,
    "op3_simhash_cover": simhash_cover.op3_simhash_cover,
    "op4_fertility": fertility.op4_fertility,
    "op5_budget_mix": budget_mix.op5_budget_mix,
    "op6_byte_bpe": byte_bpe.op6_byte_bpe,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_mtree": mtree.op9_mtree,
    "op10_crf_toxicity": crf_toxicity.op10_crf_toxicity,
}
ORACLES = {
    "op8_suffix_dedup": suffix_dedup.OP8_SQL,
    "op9_mtree": mtree.OP9_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
}
