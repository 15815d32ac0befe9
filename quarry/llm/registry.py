"""Registered queries of the operators and their SQL twins."""

from __future__ import annotations

from quarry.llm import block_topk, chat_format, decontaminate, importance_resampling, line_dedup, line_quality, minhash_dedup, pitman_yor, prefix_trie, site_style, warc
from quarry.llm.language_ppm import op9_language
from quarry.llm.sentencepiece_bpe import op3_sentencepiece

QUERIES = {
    "op1_minhash": minhash_dedup.op1_minhash,
    "op2_line_quality": line_quality.op2_line_quality,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_pitman_yor": pitman_yor.op4_pitman_yor,
    "op5_warc": warc.op5_warc,
    "op6_chat": chat_format.op6_chat,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_language": op9_language,
    "op10_main_text": site_style.op10_main_text,
    "op11_resample": importance_resampling.op11_resample,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_block_topk": block_topk.op13_block_topk,
}

#: Operators 1, 3, 4, 7, 8, 9, 10 (components of verified links, merges, spans, DOM trees, trained statistics) have no SQL form; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_line_quality": line_quality.ORACLE,
    "op5_warc": warc.ORACLE,
    "op6_chat": chat_format.ORACLE,
    "op11_resample": importance_resampling.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_block_topk": block_topk.ORACLE,
}
