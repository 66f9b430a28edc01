"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from cohortix.llm import bpe, chat, decontam, fim, langid, lm, pii, quality, sharding, simhash, substrings, urls, whitening

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_language_id": langid.op3_language_id,
    "op4_decontaminate": decontam.op4_decontaminate,
    "op5_bpe": bpe.op5_bpe,
    "op6_quality": quality.op6_quality,
    "op7_url_filter": urls.op7_url_filter,
    "op8_shards": sharding.op8_shards,
    "op9_simhash": simhash.op9_simhash,
    "op10_lm_score": lm.op10_lm_score,
    "op11_personal_data": pii.op11_personal_data,
    "op12_whitening": whitening.op12_whitening,
    "op13_fill_in_middle": fim.op13_fill_in_middle,
}

#: queries that SQL can express over whole tables
ORACLE = {
    "op1_chat_format": chat.SQL,
    "op2_substring_dedup": substrings.SQL,
    "op7_url_filter": urls.SQL,
    "op13_fill_in_middle": fim.SQL,
}
