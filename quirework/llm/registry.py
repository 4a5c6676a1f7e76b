"""Queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from quirework.llm import bpe, decontaminate, embedding_dedup, licenses, secrets, simhash, surrogates, token_store, toxicity, url_filter


def queries() -> dict:
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate,
        "op2_url_filter": url_filter.op2_url_filter,
        "op3_license_scan": licenses.op3_license_scan,
        "op4_embedding_dedup": embedding_dedup.op4_embedding_dedup,
        "op5_secret_scan": secrets.op5_secret_scan,
        "op6_pii_surrogates": surrogates.op6_pii_surrogates,
        "op7_byte_bpe": bpe.op7_byte_bpe,
        "op8_token_store": token_store.op8_token_store,
        "op9_simhash": simhash.op9_simhash,
        "op10_toxicity": toxicity.op10_toxicity,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": url_filter.ORACLE_OP2, "op3_license_scan": licenses.ORACLE_OP3, "op4_embedding_dedup": embedding_dedup.ORACLE_OP4, "op5_secret_scan": secrets.ORACLE_OP5}
