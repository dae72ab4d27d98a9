"""The registered queries of the training-data operators."""
from __future__ import annotations

from tillroll.llm import (
    divergence, embedding_dups, fingerprints, id_files, language, mixing, ngram_join, packing, search, sharding, token_counts, toxicity, url_filter)

QUERIES = {
    "op1_token_counts": token_counts.op1,
    "op2_embedding_dups": embedding_dups.op2,
    "op3_url_filter": url_filter.op3,
    "op4_toxicity": toxicity.op4,
    "op5_id_files": id_files.op5,
    "op6_mix_sources": mixing.op6,
    "op7_language": language.op7,
    "op8_ngram_join": ngram_join.op8,
    "op9_pack": packing.op9,
    "op10_fingerprints": fingerprints.op10,
    "op11_sharding": sharding.op11,
    "op12_divergence": divergence.op12,
    "op13_search": search.op13,
}

ORACLE_SQL = {
    "op3_url_filter": url_filter.oracle(),
    "op6_mix_sources": mixing.oracle(),
    "op11_sharding": sharding.oracle(),
    "op12_divergence": divergence.oracle(),
    "op13_search": search.oracle(),
}
