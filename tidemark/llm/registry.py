"""The named queries of this subpackage and their SQL twins."""

from __future__ import annotations

from tidemark.llm import (
    bpe, decontaminate, kd_shards, langid, mil_quality, mincut_html, mixing, quality_rules, simhash, spelling, substring_dedup,
    toxicity, whitening,
)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_bpe": bpe.op2_bpe,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_langid": langid.op5_langid,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_mil_quality": mil_quality.op7_mil_quality,
    "op8_kd_shards": kd_shards.op8_kd_shards,
    "op9_mincut_html": mincut_html.op9_mincut_html,
    "op10_simhash": simhash.op10_simhash,
    "op11_spelling": spelling.op11_spelling,
    "op12_whitening": whitening.op12_whitening,
    "op13_mixing": mixing.op13_mixing,
}

SQL = {
    "op1_quality_rules": quality_rules.OP1_SQL,
    "op6_substring_dedup": substring_dedup.OP6_SQL,
}
