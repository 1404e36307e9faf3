"""The queries of this package and the SQL that some can be held against."""

from __future__ import annotations

from weir.llm import chat, infill, language, merkle, mixing, pieces, quality, repeats, secrets, sharding, simhash, topk, urls

QUERIES = {
    "op10_quality": quality.op10_quality,
    "op6_sharding": sharding.op6_sharding,
    "op7_urls": urls.op7_urls,
    "op8_chat": chat.op8_chat,
    "op3_topk": topk.op3_topk,
    "op2_pieces": pieces.op2_pieces,
    "op4_mixing": mixing.op4_mixing,
    "op1_secrets": secrets.op1_secrets,
    "op5_language": language.op5_language,
    "op9_simhash": simhash.op9_simhash,
    "op11_merkle": merkle.op11_merkle,
    "op12_repeats": repeats.op12_repeats,
    "op13_infill": infill.op13_infill,
}

ORACLES: dict[str, str] = {
    "op8_chat": chat.OP8_SQL,
    "op3_topk": topk.OP3_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op7_urls": urls.OP7_SQL,
    "op11_merkle": merkle.OP11_SQL,
    "op12_repeats": repeats.OP12_SQL,
    "op13_infill": infill.OP13_SQL,
}
