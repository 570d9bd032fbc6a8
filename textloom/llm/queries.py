"""Queries of this subpackage, one per operator, and their SQL where SQL can say it."""

from __future__ import annotations

from textloom.llm import alignment, chat, decontaminate, divergence, langid, line_dedup, minhash, packing, quality, secrets, sharding, suffix_tree, toxicity

QUERIES = {
    "op1_chat": chat.op1_chat,
    "op2_secrets": secrets.op2_secrets,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_lines": line_dedup.op5_lines,
    "op6_packing": packing.op6_packing,
    "op7_minhash": minhash.op7_minhash,
    "op8_language": langid.op8_language,
    "op9_suffix_tree": suffix_tree.op9_suffix_tree,
    "op10_quality": quality.op10_quality,
    "op11_shards": sharding.op11_shards,
    "op12_alignment": alignment.op12_alignment,
    "op13_divergence": divergence.op13_divergence,
}

ORACLES = {
    "op1_chat": chat.oracle_op1(),
    "op2_secrets": secrets.oracle_op2(),
    "op3_decontamination": decontaminate.oracle_op3(),
    "op7_minhash": minhash.oracle_op7(),
    "op10_quality": quality.oracle_op10(),
    "op13_divergence": divergence.oracle_op13(),
}
