"""Registered queries of this folder."""

from __future__ import annotations

from chartfold.llm import (
    chat_format,
    fixity,
    hard_negatives,
    near_duplicates,
    prefix_trie,
    recompression,
    suffixes,
)
from chartfold.llm.chat_format import op13_chat_format
from chartfold.llm.decontamination import op9_decontamination
from chartfold.llm.fixity import op4_merkle_audit
from chartfold.llm.hard_negatives import op11_hard_negatives
from chartfold.llm.license_scan import op6_license_scan
from chartfold.llm.mixing import op1_mix_sources
from chartfold.llm.near_duplicates import op7_minhash_bayes
from chartfold.llm.prefix_trie import op12_prefix_trie
from chartfold.llm.pu_quality import op3_pu_quality
from chartfold.llm.quality_rules import op10_quality_rules
from chartfold.llm.recompression import op5_recompression
from chartfold.llm.suffixes import op8_suffix_array
from chartfold.llm.url_rules import op2_url_rules

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_url_rules": op2_url_rules,
    "op3_pu_quality": op3_pu_quality,
    "op4_merkle_audit": op4_merkle_audit,
    "op5_recompression": op5_recompression,
    "op6_license_scan": op6_license_scan,
    "op7_minhash_bayes": op7_minhash_bayes,
    "op8_suffix_array": op8_suffix_array,
    "op9_decontamination": op9_decontamination,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_chat_format": op13_chat_format,
}
ORACLES = {
    "op4_merkle_audit": fixity.ORACLE,
    "op5_recompression": recompression.ORACLE,
    "op7_minhash_bayes": near_duplicates.ORACLE,
    "op8_suffix_array": suffixes.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_chat_format": chat_format.ORACLE,
}
