"""The registered queries of the package: ``QUERIES`` and ``ORACLE``."""

from waymark.llm import (chat, conversation_repair, decontaminate, html_text, language_id, mixing, perplexity,
                         secret_scan, sentencepiece_bpe, superminhash, token_store, warc_fixity, whitening)

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_token_store": token_store.op2_token_store,
    "op3_superminhash": superminhash.op3_superminhash,
    "op4_layout_text": html_text.op4_layout_text,
    "op5_merkle_audit": warc_fixity.op5_merkle_audit,
    "op6_perplexity": perplexity.op6_perplexity,
    "op7_spaced_seeds": decontaminate.op7_spaced_seeds,
    "op8_sentencepiece": sentencepiece_bpe.op8_sentencepiece,
    "op9_language_id": language_id.op9_language_id,
    "op10_randomness_battery": secret_scan.op10_randomness_battery,
    "op11_whitening": whitening.op11_whitening,
    "op12_lightest_repair": conversation_repair.op12_lightest_repair,
    "op13_water_filling": mixing.op13_water_filling,
}
ORACLE = {
    "op1_chat_format": chat.OP1_SQL,
    "op5_merkle_audit": warc_fixity.OP5_SQL,
    "op12_lightest_repair": conversation_repair.OP12_SQL,
    "op13_water_filling": mixing.OP13_SQL,
}
