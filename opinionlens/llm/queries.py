"""Queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

from opinionlens.llm import q_bpe, q_jaccard, q_kneser_ney, q_langid, q_lexical, q_licences, q_neighbours, q_packing, q_periodic, q_quality, q_spans, q_urls, q_wrappers

QUERIES = {
    "op1_quality_rules": q_quality.op1_quality_rules,
    "op2_url_filter": q_urls.op2_url_filter,
    "op3_language_id": q_langid.op3_language_id,
    "op4_jaccard_join": q_jaccard.op4_jaccard_join,
    "op5_piece_encoding": q_bpe.op5_piece_encoding,
    "op6_kneser_ney": q_kneser_ney.op6_kneser_ney,
    "op7_sentence_spans": q_spans.op7_sentence_spans,
    "op8_nearest_neighbours": q_neighbours.op8_nearest_neighbours,
    "op9_licence_scan": q_licences.op9_licence_scan,
    "op10_packing": q_packing.op10_packing,
    "op11_html_extraction": q_wrappers.op11_html_extraction,
    "op12_periodic_runs": q_periodic.op12_periodic_runs,
    "op13_lexical_search": q_lexical.op13_lexical_search,
}

ORACLES = {
    "op1_quality_rules": q_quality.ORACLE,
    "op2_url_filter": q_urls.ORACLE,
    "op4_jaccard_join": q_jaccard.ORACLE,
    "op13_lexical_search": q_lexical.ORACLE,
}
