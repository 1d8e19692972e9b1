"""Registered queries of the training-data operators and, where SQL can express them, their oracles."""

from __future__ import annotations

from touchline.llm import html_extract, language, mixing, ngram_join, pii, quality_model, quality_rules, sentencepiece_scan, topk, toxicity

QUERIES = {
    "op1_topk": topk.query,
    "op2_language": language.query,
    "op3_quality": quality_model.query,
    "op4_pii": pii.query,
    "op5_toxicity": toxicity.query,
    "op6_sentencepiece": sentencepiece_scan.query,
    "op7_mixing": mixing.query,
    "op8_html": html_extract.query,
    "op9_jaccard": ngram_join.query,
    "op10_quality_rules": quality_rules.query,
}
ORACLES = {
    "op1_topk": topk.SQL,
    "op7_mixing": mixing.SQL,
    "op9_jaccard": ngram_join.SQL,
    "op10_quality_rules": quality_rules.SQL,
}
