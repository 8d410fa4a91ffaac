"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from feedlake.llm import chat, decontaminate, html, linededup, merkle, mix, neardup, quality, resample, secrets, tokens, toxicity, urls

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_mix": mix.op2_mix,
    "op3_chat": chat.op3_chat,
    "op4_token_ids": tokens.op4_token_ids,
    "op5_html_text": html.op5_html_text,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_url_filter": urls.op7_url_filter,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_secrets": secrets.op9_secrets,
    "op10_near_duplicates": neardup.op10_near_duplicates,
    "op11_line_dedup": linededup.op11_line_dedup,
    "op12_resample": resample.op12_resample,
    "op13_merkle": merkle.op13_merkle,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {
    "op1_quality": quality.OP1_SQL,
    "op3_chat": chat.OP3_SQL,
    "op6_decontaminate": decontaminate.OP6_SQL,
    "op7_url_filter": urls.OP7_SQL,
    "op10_near_duplicates": neardup.OP10_SQL,
    "op11_line_dedup": linededup.OP11_SQL,
    "op12_resample": resample.OP12_SQL,
    "op13_merkle": merkle.OP13_SQL,
}
