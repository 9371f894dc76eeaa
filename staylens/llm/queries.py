"""The queries of this subpackage, and their comparison SQL where SQL can say the same."""

from __future__ import annotations

from staylens.llm import brown, decontaminate, html_blocks, importance, jaccard, langid, line_crf, pieces, pu_quality, secrets, superkmers, toxicity, variants

QUERIES = {
    "op1_lm_scoring": brown.op1,
    "op2_substring_dedup": superkmers.op2,
    "op3_secret_scan": secrets.op3,
    "op4_decontamination": decontaminate.op4,
    "op5_language_id": langid.op5,
    "op6_jaccard_join": jaccard.op6,
    "op7_sentencepiece": pieces.op7,
    "op8_html_extraction": html_blocks.op8,
    "op9_quality_rules": line_crf.op9,
    "op10_quality_classifier": pu_quality.op10,
    "op11_toxicity": toxicity.op11,
    "op12_importance_resampling": importance.op12,
    "op13_spelling_variants": variants.op13,
}

#: The others learn, or compute what SQL can only spell out for small tables; tests hold them against plain versions.
SQL = {"op2_substring_dedup": superkmers.SQL, "op4_decontamination": decontaminate.SQL, "op12_importance_resampling": importance.SQL, "op13_spelling_variants": variants.SQL}
