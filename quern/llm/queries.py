"""The queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from quern.llm import decontaminate, embedding_dedup, hmm_lm, language_id, minhash, mixing, quality, surrogates, token_counts, url_filter

QUERIES = {
    "op1_hmm_lm": hmm_lm.op1_hmm_lm,
    "op2_quality_fm": quality.op2_quality_fm,
    "op3_surrogates": surrogates.op3_surrogates,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_url_rules": url_filter.op5_url_rules,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_systematic_mix": mixing.op7_systematic_mix,
    "op8_embedding_neardup": embedding_dedup.op8_embedding_neardup,
    "op9_language_id": language_id.op9_language_id,
    "op10_minhash_neardup": minhash.op10_minhash_neardup,
}

ORACLE = {
    "op4_decontaminate": decontaminate.SQL,
    "op5_url_rules": url_filter.SQL,
    "op7_systematic_mix": mixing.SQL,
    "op8_embedding_neardup": embedding_dedup.SQL,
    "op10_minhash_neardup": minhash.SQL,
}
