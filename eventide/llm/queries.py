"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from eventide.llm import (attention_lm, grid_join, license_scan, mixing, packing, rotated_codes, source_audit, style_tree,
                          suffix_dedup, toxic_spans, turn_repair, url_rules, weighted_minhash)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_rotated_codes": rotated_codes.op2_rotated_codes,
    "op3_toxic_spans": toxic_spans.op3_toxic_spans,
    "op4_attention_lm": attention_lm.op4_attention_lm,
    "op5_style_tree": style_tree.op5_style_tree,
    "op6_mix": mixing.op6_mix,
    "op7_grid_join": grid_join.op7_grid_join,
    "op8_weighted_minhash": weighted_minhash.op8_weighted_minhash,
    "op9_url_rules": url_rules.op9_url_rules,
    "op10_pack": packing.op10_pack,
    "op11_turn_repair": turn_repair.op11_turn_repair,
    "op12_source_audit": source_audit.op12_source_audit,
    "op13_license_scan": license_scan.op13_license_scan,
}
SQL = {"op7_grid_join": grid_join.OP7_SQL, "op9_url_rules": url_rules.OP9_SQL,
       "op11_turn_repair": turn_repair.OP11_SQL, "op12_source_audit": source_audit.OP12_SQL,
       "op13_license_scan": license_scan.OP13_SQL}
