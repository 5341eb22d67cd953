"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from ledgerloom.llm import collocations, decontaminate, line_rules, media_copies, mixing, periodic_runs, preference_format, quality_fm, secret_scan, simhash_dedup, suffix_dedup, token_rollup, url_filter

QUERIES = {
    "op1_token_counts": token_rollup.op1_token_counts,
    "op2_media_copies": media_copies.op2_media_copies,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_quality_fm": quality_fm.op4_quality_fm,
    "op5_simhash_dedup": simhash_dedup.op5_simhash_dedup,
    "op6_preference_format": preference_format.op6_preference_format,
    "op7_mixing": mixing.op7_mixing,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_collocations": collocations.op11_collocations,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_line_rules": line_rules.op13_line_rules,
}

ORACLES = {
    "op1_token_counts": token_rollup.ORACLE,
    "op3_secret_scan": secret_scan.ORACLE,
    "op5_simhash_dedup": simhash_dedup.ORACLE,
    "op6_preference_format": preference_format.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op8_suffix_dedup": suffix_dedup.ORACLE,
    "op9_decontaminate": decontaminate.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_periodic_runs": periodic_runs.ORACLE,
    "op13_line_rules": line_rules.ORACLE,
}
