"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from registrar_feeds.llm import (
    class_lm,
    divergence,
    exact_dedup,
    html_text,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    topk_search,
    vector_codes,
)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_pack": packing.op2_pack,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_html_text": html_text.op4_html_text,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_topk_search": topk_search.op6_topk_search,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_ngram_join": ngram_join.op8_ngram_join,
    "op9_language_id": language_id.op9_language_id,
    "op10_mix": mixing.op10_mix,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_class_lm": class_lm.op13_class_lm,
}

ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": line_dedup.OP3_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op6_topk_search": topk_search.OP6_SQL,
    "op8_ngram_join": ngram_join.OP8_SQL,
    "op11_source_divergence": divergence.OP11_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
}
