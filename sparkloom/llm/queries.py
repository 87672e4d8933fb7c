"""The queries of the text operators and their SQL."""

from __future__ import annotations

from sparkloom.llm import bpe, chat_format, exact_dedup, hard_negatives, html_extract, language_id, minhash_dedup, mixing, quality_rules, secrets_scan, substring_dedup, url_filter, whitening

QUERIES = {
    "op1_substring_dedup": substring_dedup.query,
    "op2_mixing": mixing.query,
    "op3_exact_dedup": exact_dedup.query,
    "op4_bpe": bpe.query,
    "op5_chat": chat_format.query,
    "op6_minhash": minhash_dedup.query,
    "op7_language_id": language_id.query,
    "op8_html": html_extract.query,
    "op9_secrets": secrets_scan.query,
    "op10_quality_rules": quality_rules.query,
    "op11_whitening": whitening.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_url_filter": url_filter.query,
}
ORACLES: dict[str, str] = {"op3_exact_dedup": exact_dedup.ORACLE, "op5_chat": chat_format.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE, "op13_url_filter": url_filter.ORACLE}
