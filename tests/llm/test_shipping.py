from tests.test_shipping import run_apart


def test_operators_run_apart(tmp_path):
    run_apart(tmp_path, "ledgerloom.llm.queries", ["op2_media_copies", "op4_quality_fm", "op5_simhash_dedup", "op8_suffix_dedup", "op9_decontaminate"])
