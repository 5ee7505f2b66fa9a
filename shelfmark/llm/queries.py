"""The subpackage's queries and their SQL."""

from __future__ import annotations

from shelfmark.llm import alignment, chat, decontam, licenses, mixing, order_minhash, prefix_trie, quality, rules, simhash, token_files, toxicity, url_filter
from shelfmark.llm.sql import ORACLES

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_quality": quality.op2_quality,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_mixing": mixing.op4_mixing,
    "op5_rules": rules.op5_rules,
    "op6_decontam": decontam.op6_decontam,
    "op7_licenses": licenses.op7_licenses,
    "op8_token_files": token_files.op8_token_files,
    "op9_simhash": simhash.op9_simhash,
    "op10_chat": chat.op10_chat,
    "op11_trie": prefix_trie.op11_trie,
    "op12_fingerprint": order_minhash.op12_fingerprint,
    "op13_align": alignment.op13_align,
    "op6_near": decontam.op6_near,
}
