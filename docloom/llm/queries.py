"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from docloom.llm import exact_dedup, katz, language, licences, mixing, packing, simhash, substring, toxicity, trie, vectors, whitening, wrappers

QUERIES = {
    "op1_pareto_mix": mixing.query,
    "op2_wrapper_text": wrappers.query,
    "op3_pu_toxicity": toxicity.query,
    "op4_product_quantisation": vectors.query,
    "op5_katz_backoff": katz.query,
    "op6_covering_simhash": simhash.query,
    "op7_seed_extend": substring.query,
    "op8_length_buckets": packing.query,
    "op9_licence_classifier": licences.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_ftrl_language": language.query,
    "op12_zfast_trie": trie.query,
    "op13_exact_whitening": whitening.query,
}

ORACLES = {
    "op1_pareto_mix": mixing.ORACLE,
    "op7_seed_extend": substring.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op12_zfast_trie": trie.ORACLE,
}
