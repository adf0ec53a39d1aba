"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

import corpus_pipeline
from postlens.llm import bwt, decontaminate, langid, lines, mixing, pii, quality, repair, sharding, simhash, suffix_tree, topk, variants

QUERIES = {
    "op1_line_dedup": lines.op1_line_dedup,
    "op2_pii": pii.op2_pii,
    "op3_topk_search": topk.op3_topk_search,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_substring_dedup": suffix_tree.op6_substring_dedup,
    "op7_suffix_array_dedup": bwt.op7_suffix_array_dedup,
    "op8_quality": quality.op8_quality,
    "op9_simhash_dedup": simhash.op9_simhash_dedup,
    "op10_langid": langid.op10_langid,
    "op11_spelling_variants": variants.op11_spelling_variants,
    "op12_conversation_repair": repair.op12_conversation_repair,
    "op13_sharding": sharding.op13_sharding,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {"op1_line_dedup": lines.ORACLE, "op4_decontaminate": decontaminate.ORACLE,
           "op3_topk_search": topk.ORACLE, "op5_mix_sources": mixing.ORACLE,
           "op11_spelling_variants": variants.ORACLE, "op12_conversation_repair": repair.ORACLE, "op13_sharding": sharding.ORACLE}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def all_queries():
    return QUERIES


def all_oracles():
    return ORACLES
