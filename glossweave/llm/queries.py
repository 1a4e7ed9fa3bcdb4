"""The queries of this folder, and their SQL where there is some."""

from . import bpe_codec, jaccard_join, language_id, packing, pii, quality_rules, substring_dedup, suffix_dedup, token_counts, topk_search

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_topk_search": topk_search.op5_topk_search,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_bpe_codec": bpe_codec.op9_bpe_codec,
    "op10_pii": pii.op10_pii,
}
SQL = {"op2_substring_dedup": substring_dedup.SQL, "op5_topk_search": topk_search.SQL, "op6_quality_rules": quality_rules.SQL}
