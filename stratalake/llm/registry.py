"""The queries of this subpackage, and the SQL of those that SQL can express."""

from stratalake.llm import blobs, digests, jaccard, language, lines, lm, merkle, mixing, packing, personal, quality, ranked, repeats

QUERIES = {
    "op1_substring_dedup": repeats.op1_substring_dedup,
    "op2_lm_scoring": lm.op2_lm_scoring,
    "op3_language_id": language.op3_language_id,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_line_dedup": lines.op6_line_dedup,
    "op7_jaccard_join": jaccard.op7_jaccard_join,
    "op8_personal_data": personal.op8_personal_data,
    "op9_fingerprints": digests.op9_fingerprints,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_ranked_search": ranked.op11_ranked_search,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_secret_scans": blobs.op13_secret_scans,
}
ORACLES = {
    "op2_lm_scoring": lm.OP2_SQL,
    "op6_line_dedup": lines.OP6_SQL,
    "op7_jaccard_join": jaccard.OP7_SQL,
    "op10_quality_rules": quality.OP10_SQL,
    "op11_ranked_search": ranked.OP11_SQL,
    "op12_merkle_manifest": merkle.OP12_SQL,
    "op13_secret_scans": blobs.OP13_SQL,
}
