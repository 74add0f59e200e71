"""The queries of this subpackage and their SQL, for the driver's entry module."""

from __future__ import annotations

from . import bpe, decontaminate, exact_dedup, html_text, jaccard_join, language, licenses, lm, mixing, pii, spelling, toxicity, whitening

_BY_NAME = {
    "op1_jaccard_join": jaccard_join,
    "op2_licenses": licenses,
    "op3_lm": lm,
    "op4_toxicity": toxicity,
    "op5_exact_dedup": exact_dedup,
    "op6_html_text": html_text,
    "op7_decontaminate": decontaminate,
    "op8_mixing": mixing,
    "op9_language": language,
    "op10_pii": pii,
    "op11_whitening": whitening,
    "op12_bpe": bpe,
    "op13_spelling": spelling,
}


def queries() -> dict:
    return {name: module.query for name, module in _BY_NAME.items()}


def oracle_sql() -> dict:
    return {name: module.SQL for name, module in _BY_NAME.items() if getattr(module, "SQL", None)}
