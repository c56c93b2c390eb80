"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from batchlens.llm import (centroids, importance, language_id, language_model, license_scan, packing, parity_join,
                           quality_model, quality_rules, token_files, topk, warc, winnowing)

QUERIES = {
    "op1_language_id": language_id.query,
    "op2_quality_model": quality_model.query,
    "op3_warc": warc.query,
    "op4_best_fit": packing.query,
    "op5_license_scan": license_scan.query,
    "op6_token_files": token_files.query,
    "op7_quality_rules": quality_rules.query,
    "op8_language_model": language_model.query,
    "op9_decontamination": winnowing.query,
    "op10_parity_join": parity_join.query,
    "op11_centroids": centroids.query,
    "op12_topk": topk.query,
    "op13_importance": importance.query,
}

ORACLES = {
    "op3_warc": warc.ORACLE,
    "op5_license_scan": license_scan.oracle(),
    "op7_quality_rules": quality_rules.ORACLE,
    "op9_decontamination": winnowing.ORACLE,
    "op11_centroids": centroids.oracle(),
    "op12_topk": topk.ORACLE,
}
