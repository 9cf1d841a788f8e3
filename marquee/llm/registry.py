"""Queries and DuckDB SQL of the training-data operators, added to the library's by ``__spark_entry__``."""

from __future__ import annotations

from marquee.llm import (
    bpe_automaton, chat_format, collocations, exact_dedup, license_scan, masked_lm, merkle, mixing, ngram_join, preference, quality_rules, repeats,
    toxicity)

QUERIES = {
    "op7_masked_lm": masked_lm.op7_masked_lm,
    "op2_suffix_dedup": repeats.op2_suffix_dedup,
    "op3_license_scan": license_scan.op3_license_scan,
    "op5_chat_format": chat_format.op5_chat_format,
    "op6_toxicity": toxicity.op6_toxicity,
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op9_bpe_automaton": bpe_automaton.op9_bpe_automaton,
    "op10_mix_sources": mixing.op10_mix_sources,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op11_preference_quality": preference.op11_preference_quality,
    "op12_phrase_collocations": collocations.op12_phrase_collocations,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

SQL = {
    "op3_license_scan": license_scan.SQL,
    "op1_ngram_join": ngram_join.SQL,
    "op4_quality_rules": quality_rules.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op12_phrase_collocations": collocations.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
