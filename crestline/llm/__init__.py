"""Operators of a training-data pipeline, and the queries that apply them to whole tables."""

from __future__ import annotations

from crestline.llm import (
    decontam, extraction, langid, lexical, licenses, minhash, mixing, quality, secrets, suffix_dedup, token_store,
    topk, whitening,
)


def queries() -> dict:
    return {
        "op1_language_id": langid.op1_language_id,
        "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
        "op3_minhash_dedup": minhash.op3_minhash_dedup,
        "op4_quality_classifier": quality.op4_quality_classifier,
        "op5_topk_search": topk.op5_topk_search,
        "op6_secret_scan": secrets.op6_secret_scan,
        "op7_token_store": token_store.op7_token_store,
        "op8_license_scan": licenses.op8_license_scan,
        "op9_decontamination": decontam.op9_decontamination,
        "op10_source_mixing": mixing.op10_source_mixing,
        "op11_html_extraction": extraction.op11_html_extraction,
        "op12_lexical_search": lexical.op12_lexical_search,
        "op13_embedding_whitening": whitening.op13_embedding_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_minhash_dedup": minhash.NEAR_SQL,
        "op5_topk_search": topk.TOPK_SQL,
        "op6_secret_scan": secrets.SECRETS_SQL,
        "op8_license_scan": licenses.LICENSES_SQL,
        "op11_html_extraction": extraction.ARTICLES_SQL,
        "op12_lexical_search": lexical.LEXICAL_SQL,
    }
