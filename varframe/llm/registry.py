"""Queries of this subpackage and their SQL twins, by name."""

from __future__ import annotations

from . import (
    bpe,
    chat,
    decontaminate,
    exact_dedup,
    fim,
    hard_negatives,
    language_id,
    line_dedup,
    near_dedup,
    secrets,
    sharding,
    token_counts,
    url_filter,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_chat_format": chat.op4_chat_format,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_bpe": bpe.op6_bpe,
    "op7_language_id": language_id.op7_language_id,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_sharding": sharding.op12_sharding,
    "op13_fill_in_middle": fim.op13_fill_in_middle,
}

SQL = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op3_url_filter": url_filter.OP3_SQL,
    "op4_chat_format": chat.OP4_SQL,
    "op8_decontaminate": decontaminate.OP8_SQL,
    "op10_line_dedup": line_dedup.OP10_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op12_sharding": sharding.OP12_SQL,
    "op13_fill_in_middle": fim.OP13_SQL,
}
