"""The registered queries of this subpackage and their oracles."""

from __future__ import annotations

from . import (
    chat, decontaminate, kdtree, language, licenses, line_dedup, merkle, minhash, mixing, packing, prefix_trie, tokens, warc,
)


def load() -> tuple[dict, dict]:
    queries = {
        "op1_chat_format": chat.op1,
        "op2_kdtree_topk": kdtree.op2,
        "op3_language_id": language.op3,
        "op4_token_counts": tokens.op4,
        "op5_minhash": minhash.op5,
        "op6_license_scan": licenses.op6,
        "op7_decontaminate": decontaminate.op7,
        "op8_mixing": mixing.op8,
        "op9_warc": warc.op9,
        "op10_line_dedup": line_dedup.op10,
        "op11_merkle_manifest": merkle.op11,
        "op12_prefix_trie": prefix_trie.op12,
        "op13_harmonic_packing": packing.op13,
    }
    oracles = {
        "op1_chat_format": chat.ORACLE, "op2_kdtree_topk": kdtree.ORACLE,
        "op8_mixing": mixing.ORACLE, "op9_warc": warc.ORACLE, "op10_line_dedup": line_dedup.ORACLE,
        "op11_merkle_manifest": merkle.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE}
    return queries, oracles
