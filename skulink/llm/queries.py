"""Registered queries of the training-data operators, and their SQL where it exists."""

from __future__ import annotations

import corpus_pipeline
from skulink.llm.bpe import op5_bpe
from skulink.llm.chatformat import op11_chat_format
from skulink.llm.decontam import op9_decontaminate
from skulink.llm.masked_lm import op2_masked_lm
from skulink.llm.merkle import op12_merkle
from skulink.llm.ngramjoin import op4_ngram_join
from skulink.llm.oracle import LLM_ORACLE  # noqa: F401
from skulink.llm.pii import op1_pii
from skulink.llm.quality import op3_quality
from skulink.llm.repair import op13_repair
from skulink.llm.shard import op10_shard
from skulink.llm.tokcount import op8_tokens
from skulink.llm.toxicity import op6_toxicity
from skulink.llm.urlgraph import op7_url_filter

LLM_QUERIES = {f.__name__: f for f in (
    op1_pii, op2_masked_lm, op3_quality, op4_ngram_join, op5_bpe, op6_toxicity, op7_url_filter,
    op8_tokens, op9_decontaminate, op10_shard, op11_chat_format,
    op12_merkle, op13_repair)}
LLM_QUERIES["pipeline"] = corpus_pipeline.run
