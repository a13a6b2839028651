"""The operators as registered queries, with oracle SQL where SQL can express them."""

from __future__ import annotations

from . import language_model, line_dedup, lsh_forest, mixing, packing, quality, resharding, search, simhash, spelling, substring_dedup, token_files, whitening


def queries() -> dict:
    return {
        "op1_line_dedup": line_dedup.query,
        "op2_pitman_yor": language_model.query,
        "op3_mixing": mixing.query,
        "op4_simhash_near_dedup": simhash.query,
        "op5_packing": packing.query,
        "op6_resharding": resharding.query,
        "op7_topk_search": search.query,
        "op8_substring_dedup": substring_dedup.query,
        "op9_token_files": token_files.query,
        "op10_quality_perplexity": quality.query,
        "op11_whitening": whitening.query,
        "op12_lsh_forest": lsh_forest.query,
        "op13_spelling_variants": spelling.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE, "op3_mixing": mixing.ORACLE}
