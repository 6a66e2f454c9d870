"""All queries of this folder and their SQL."""

from tickspark.llm import (
    q_centroid_clustering, q_chat_format, q_embedding_dedup, q_exact_dedup, q_language_id, q_line_dedup, q_lm_scoring, q_mixing, q_ngram_join,
    q_packing, q_pii, q_topk_search, q_whitening)

MODULES = [
    q_centroid_clustering, q_chat_format, q_embedding_dedup, q_exact_dedup, q_language_id, q_line_dedup, q_lm_scoring, q_mixing, q_ngram_join,
    q_packing, q_pii, q_topk_search, q_whitening]
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
