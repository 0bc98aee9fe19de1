"""The registered queries of the subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from . import (
    decontaminate, fill_in_middle, fingerprints, language_id, line_dedup, near_dedup, packing, prefix_trie, quality, sharding,
    substring_dedup, token_files, toxicity)

QUERIES = {f.__name__: f for f in (
    fingerprints.op1_fingerprints,
    decontaminate.op2_benchmark_decontamination,
    language_id.op3_language_id,
    substring_dedup.op4_substring_dedup,
    sharding.op5_sharding,
    toxicity.op6_toxicity,
    packing.op7_packing,
    quality.op8_quality_classifier,
    line_dedup.op9_line_dedup,
    near_dedup.op10_minhash_near_dedup,
    prefix_trie.op11_prefix_trie,
    token_files.op12_token_files,
    fill_in_middle.op13_fill_in_middle,
)}

ORACLE_SQL = {
    "op2_benchmark_decontamination": decontaminate.ORACLE_SQL,
    "op5_sharding": sharding.ORACLE_SQL,
    "op9_line_dedup": line_dedup.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie.ORACLE_SQL,
    "op13_fill_in_middle": fill_in_middle.ORACLE_SQL,
}
