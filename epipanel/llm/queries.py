"""Registry of this subpackage's queries and of their SQL."""

from __future__ import annotations

from epipanel.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    importance,
    langid,
    language_model,
    license_scan,
    ngram_jaccard,
    packing,
    sentence_spans,
    spelling,
    token_counts,
    warc,
)


def queries() -> dict:
    return {
        "op1_lm_scoring": language_model.query,
        "op2_warc": warc.query,
        "op3_decontaminate": decontaminate.query,
        "op4_license_scan": license_scan.query,
        "op5_sentence_spans": sentence_spans.query,
        "op6_language_id": langid.query,
        "op7_chat_format": chat_format.query,
        "op8_best_fit_packing": packing.query,
        "op9_ngram_jaccard": ngram_jaccard.query,
        "op10_exact_dedup": exact_dedup.query,
        "op11_importance_resampling": importance.query,
        "op12_token_counts": token_counts.query,
        "op13_spelling_variants": spelling.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": warc.ORACLE_SQL,
        "op4_license_scan": license_scan.ORACLE_SQL,
        "op7_chat_format": chat_format.ORACLE_SQL,
        "op9_ngram_jaccard": ngram_jaccard.ORACLE_SQL,
        "op10_exact_dedup": exact_dedup.ORACLE_SQL,
        "op11_importance_resampling": importance.ORACLE_SQL,
        "op13_spelling_variants": spelling.ORACLE_SQL,
    }
