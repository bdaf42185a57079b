"""Queries of the corpus operators and, where SQL can express them, the SQL that each must equal."""

from __future__ import annotations

from tramline.llm import decontamination, infill, licenses, neardup, packing, prefixtrie, quality, scoring, secrets, sharding, superminhash, tokencounts, toxicity

QUERIES = {
    "op1_decontamination": decontamination.op1_decontamination,
    "op2_packing": packing.op2_packing,
    "op3_quality": quality.op3_quality,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_token_counts": tokencounts.op5_token_counts,
    "op6_jaccard_join": neardup.op6_jaccard_join,
    "op7_secrets": secrets.op7_secrets,
    "op8_sharding": sharding.op8_sharding,
    "op9_lm_score": scoring.op9_lm_score,
    "op10_licenses": licenses.op10_licenses,
    "op11_fill_in_middle": infill.op11_fill_in_middle,
    "op12_minhash_dedup": superminhash.op12_minhash_dedup,
    "op13_prefix_trie": prefixtrie.op13_prefix_trie,
    "licenses_planted": licenses.licenses_planted,
    "secrets_planted": secrets.secrets_planted,
    "secrets_second_scan": secrets.secrets_second_scan,
}

SQL = {
    "op1_decontamination": decontamination.ORACLE_SQL,
    "op3_quality": quality.ORACLE_SQL,
    "op7_secrets": secrets.ORACLE_SQL,
    "op11_fill_in_middle": infill.ORACLE_SQL,
    "op12_minhash_dedup": superminhash.ORACLE_SQL,
    "op13_prefix_trie": prefixtrie.ORACLE_SQL,
    "licenses_planted": licenses.PLANTED_SQL,
    "secrets_planted": secrets.PLANTED_SQL,
    "secrets_second_scan": secrets.SECOND_SCAN_SQL,
}
