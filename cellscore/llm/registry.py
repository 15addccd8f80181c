"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from cellscore.llm import op1_language, op10_hmm, op11_whitening, op12_parsing, op13_negatives, op2_decontaminate, op3_shards, op4_toxicity, op5_secrets, op6_binary, op7_pack, op8_quality, op9_simhash


def queries() -> dict:
    return {
        "op1_language_filters": op1_language.query,
        "op2_benchmark_windows": op2_decontaminate.query,
        "op3_kd_shards": op3_shards.query,
        "op4_toxicity_pu": op4_toxicity.query,
        "op5_secret_layers": op5_secrets.query,
        "op6_context_mixing": op6_binary.query,
        "op7_dynamic_packing": op7_pack.query,
        "op8_host_quality": op8_quality.query,
        "op9_simhash_bktrees": op9_simhash.query,
        "op10_hidden_markov": op10_hmm.query,
        "op11_jacobi_davidson": op11_whitening.query,
        "op12_consistent_parsing": op12_parsing.query,
        "op13_slot_negatives": op13_negatives.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_benchmark_windows": op2_decontaminate.ORACLE_SQL, "op8_host_quality": op8_quality.ORACLE_SQL, "op13_slot_negatives": op13_negatives.ORACLE_SQL}
