"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import ann, bpe, chat, conversation_repair, divergence, exact_dedup, html_extract, ngram_join, packing, piece_bpe, quality, secret_scan, toxicity

QUERIES = {
    "op1_html_extraction": html_extract.op1_html_extraction,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op4_byte_bpe": bpe.op4_byte_bpe,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_nearest_neighbours": ann.op7_nearest_neighbours,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_chat_formatting": chat.op9_chat_formatting,
    "op10_quality_classifier": quality.op10_quality_classifier,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_sentencepiece": piece_bpe.op13_sentencepiece,
}
SQL = {
    "op3_secret_scan": secret_scan.OP3_SQL,
    "op8_exact_dedup": exact_dedup.OP8_SQL,
    "op9_chat_formatting": chat.OP9_SQL,
    "op11_conversation_repair": conversation_repair.OP11_SQL,
    "op12_source_divergence": divergence.OP12_SQL,
}
