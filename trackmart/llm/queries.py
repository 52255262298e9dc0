"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from trackmart.llm import decontamination, html_text, language, near_dedup, packing, periodic_runs, prefix_trie, quality, secret_scan, sharding, spotsigs, suffix_dedup, token_rollup

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_decontamination": decontamination.op3_decontamination,
    "op4_language_id": language.op4_language_id,
    "op5_quality_classifier": quality.op5_quality_classifier,
    "op6_html_text": html_text.op6_html_text,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_token_counts": token_rollup.op8_token_counts,
    "op9_sharding": sharding.op9_sharding,
    "op10_spotsigs": spotsigs.op10_spotsigs,
    "similar_fingerprints": spotsigs.similar_fingerprints,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_secret_scan": secret_scan.op13_secret_scan,
}

SQL: dict[str, str] = {
    "op2_near_dedup": near_dedup.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_periodic_runs": periodic_runs.SQL,
}
