"""Queries of the training-data operators: name -> callable, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bagminhash, exact_dedup, hard_negatives, license_scan, mixing, multi_index, packing, prefix_trie, site_templates,
               token_counts, toxicity, warc, weak_rules)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": packing.op1_packing,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_site_templates": site_templates.op3_site_templates,
    "op4_bagminhash": bagminhash.op4_bagminhash,
    "op5_warc": warc.op5_warc,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_multi_index": multi_index.op7_multi_index,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_weak_rules": weak_rules.op11_weak_rules,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op5_warc": warc.ORACLE,
    "op6_license_scan": license_scan.ORACLE,
    "op8_mix_sources": mixing.ORACLE,
    "op11_weak_rules": weak_rules.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
