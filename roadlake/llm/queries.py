"""The named queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from roadlake.llm import decontam, divergence, fingerprints, kdtree, langid, neardup, periods, pii, pieces, substrings, suffixes, toxicity, urls

QUERIES = {
    "op1_jaccard_join": neardup.op1_jaccard_join,
    "op2_url_filters": urls.op2_url_filters,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_substring_dedup": substrings.op5_substring_dedup,
    "op6_suffix_dedup": suffixes.op6_suffix_dedup,
    "op7_decontamination": decontam.op7_decontamination,
    "op8_top_k": kdtree.op8_top_k,
    "op9_language_id": langid.op9_language_id,
    "op10_pii": pii.op10_pii,
    "op11_divergence_audit": divergence.op11_divergence_audit,
    "op12_periodic_runs": periods.op12_periodic_runs,
    "op13_fingerprints": fingerprints.op13_fingerprints,
}
ORACLES = {
    "op1_jaccard_join": neardup.ORACLE,
    "op2_url_filters": urls.ORACLE,
    "op5_substring_dedup": substrings.ORACLE,
    "op8_top_k": kdtree.ORACLE,
    "op11_divergence_audit": divergence.ORACLE,
    "op12_periodic_runs": periods.ORACLE,
    "op13_fingerprints": fingerprints.ORACLE,
}
