"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from metrivane.llm import (
    alignment, ann, bpe_chunks, exact_dedup, jaccard_join, packing, phrases, pii, token_counts, token_files, toxicity, url_filter, warc,
)

QUERIES = {
    "op1_ngram_jaccard": jaccard_join.op1_ngram_jaccard,
    "op2_neighbours": ann.op2_neighbours,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_bpe_chunks": bpe_chunks.op6_bpe_chunks,
    "op7_token_files": token_files.op7_token_files,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_warc": warc.op9_warc,
    "op10_pii": pii.op10_pii,
    "op11_phrases": phrases.op11_phrases,
    "op12_token_counts": token_counts.op12_token_counts,
    "op13_alignment": alignment.op13_alignment,
}

ORACLE = {
    "op8_exact_dedup": exact_dedup.SQL,
    "op9_warc": warc.SQL,
    "op11_phrases": phrases.SQL,
}
