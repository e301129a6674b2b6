"""The corpus operators' queries and their SQL, by name."""

from __future__ import annotations

from . import bpe, chat, crosstok, ids, infill, leaks, licenses, lines, near, passages, quality, suffixes, suffixtree

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_substring_dedup": passages.op2_substring_dedup,
    "op3_minhash_dedup": near.op3_minhash_dedup,
    "op4_decontamination": leaks.op4_decontamination,
    "op5_line_dedup": lines.op5_line_dedup,
    "op6_chat_formatting": chat.op6_chat_formatting,
    "op7_token_ids": ids.op7_token_ids,
    "op8_bpe_encoding": bpe.op8_bpe_encoding,
    "op9_exact_substrings": suffixes.op9_exact_substrings,
    "op10_license_scan": licenses.op10_license_scan,
    "op11_lm_scoring": suffixtree.op11_lm_scoring,
    "op12_fill_in_middle": infill.op12_fill_in_middle,
    "op13_token_alignment": crosstok.op13_token_alignment,
}
ORACLES = {
    "op1_quality_rules": quality.ORACLE_SQL,
    "op3_minhash_dedup": near.ORACLE_SQL,
    "op4_decontamination": leaks.ORACLE_SQL,
    "op5_line_dedup": lines.ORACLE_SQL,
    "op6_chat_formatting": chat.ORACLE_SQL,
    "op10_license_scan": licenses.ORACLE_SQL,
    "op12_fill_in_middle": infill.ORACLE_SQL,
}
