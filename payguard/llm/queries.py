"""The operators as named queries, and SQL that must give the same rows."""

from __future__ import annotations

from payguard.llm import clustering, counts, divergence, language, mixing, pieces, quality, sharding, simhash, substrings, suffixes, syncmers, warc

QUERIES = {
    "op1_syncmers": syncmers.op1_syncmers,
    "op2_simhash": simhash.op2_simhash,
    "op3_mixing": mixing.op3_mixing,
    "op4_sharding": sharding.op4_sharding,
    "op5_warc_derivatives": warc.op5_warc_derivatives,
    "op6_substrings": substrings.op6_substrings,
    "op7_language": language.op7_language,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_quality": quality.op9_quality,
    "op10_suffix_arrays": suffixes.op10_suffix_arrays,
    "op11_clustering": clustering.op11_clustering,
    "op12_token_counts": counts.op12_token_counts,
    "op13_divergence": divergence.op13_divergence,
}

SQL = {"op3_mixing": mixing.SQL, "op6_substrings": substrings.SQL, "op11_clustering": clustering.SQL, "op13_divergence": divergence.SQL}
