"""The dealt operators as registered queries, with DuckDB SQL where it can state them."""

from __future__ import annotations

from tidemark.llm import (alignment, decontaminate, embedding_dedup, exact_dedup, html_text, language, merkle, near_dedup, packing,
                          pii, secrets, suffix_dedup, token_planes)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op10_pii": pii.op10_pii,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_language_id": language.op6_language_id,
    "op7_html_text": html_text.op7_html_text,
    "language_id_pages": language.language_id_pages,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op4_token_planes": token_planes.op4_token_planes,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_embedding_dedup": embedding_dedup.op12_embedding_dedup,
    "op13_token_alignment": alignment.op13_token_alignment,
}

ORACLE = {
    "op3_decontaminate": decontaminate.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
}
