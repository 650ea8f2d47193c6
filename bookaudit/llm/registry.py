"""Queries and SQL of this subpackage."""

from __future__ import annotations

from . import exact_dedup, fill_middle, html_extract, line_rules, mixing, near_dedup, packing, quality, sharding, spelling, suffix_dedup, topk, toxicity


def queries() -> dict:
    found = (exact_dedup.op1_counting_quotient, packing.op2_retrieval_packing, html_extract.op3_consensus_paths, toxicity.op4_weak_supervision, mixing.op5_raking, near_dedup.op6_setsketch, suffix_dedup.op7_difference_cover, quality.op8_rule_ensemble, topk.op9_norm_buckets, sharding.op10_sampled_splitters, line_rules.op11_line_rules, fill_middle.op12_class_runs, spelling.op13_two_automata)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {**exact_dedup.ORACLE, **topk.ORACLE, **line_rules.ORACLE, **fill_middle.ORACLE}
