"""Registered queries of the subpackage and the SQL twins of those that SQL can express."""

from __future__ import annotations

from meterloom.llm import alignment, bpe, clustering, language, neighbours, ngram_join, packing, page_text, quality, secret_scan, sharding, substrings, toxicity

QUERIES = {
    "op1_jaccard": ngram_join.op1_jaccard,
    "op1_links": ngram_join.op1_links,
    "op2_neighbours": neighbours.op2_neighbours,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_substrings": substrings.op4_substrings,
    "op5_packing": packing.op5_packing,
    "op6_bpe": bpe.op6_bpe,
    "op7_quality": quality.op7_quality,
    "op8_html": page_text.op8_html,
    "op9_secrets": secret_scan.op9_secrets,
    "op10_language": language.op10_language,
    "op11_sharding": sharding.op11_sharding,
    "op12_alignment": alignment.op12_alignment,
    "op13_clustering": clustering.op13_clustering,
}

ORACLES = {
    "op1_jaccard": ngram_join.ORACLE,
    "op1_links": ngram_join.LINKS_ORACLE,
    "op4_substrings": substrings.ORACLE,
    "op9_secrets": secret_scan.ORACLE,
    "op11_sharding": sharding.ORACLE,
    "op13_clustering": clustering.ORACLE,
}
