"""The registered queries of the training-data operators, and SQL for the same answers."""

from __future__ import annotations

from vitrine.llm import exact_dedup, language, line_dedup, main_text, mixing, near_dedup, neighbours, ngram_join, pieces, sharding, token_links, toxicity, vector_codes

QUERIES = {
    "op1_main_text": main_text.op1_main_text,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_jump_shards": sharding.op3_jump_shards,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_sentencepiece": pieces.op5_sentencepiece,
    "op6_language": language.op6_language,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_neighbours": neighbours.op10_neighbours,
    "op11_ngram_join": ngram_join.op11_ngram_join,
    "op12_token_links": token_links.op12_token_links,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

SQL = {
    "op3_jump_shards": sharding.OP3_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
    "op8_mix_sources": mixing.OP8_SQL,
    "op9_exact_dedup": exact_dedup.OP9_SQL,
    "op11_ngram_join": ngram_join.OP11_SQL,
    "op13_vector_codes": vector_codes.OP13_SQL,
}
