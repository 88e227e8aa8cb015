"""Sentence embeddings with a pluggable encoder.

Texts are embedded once per *distinct* text and joined back, so a text
that appears in many pairs costs one encoder pass.  The pipeline:
tokenise + stop-word filter (X9, F7) -> encoder -> pooling (A9) -> L2
normalise (X13).

An encoder is a function ``Column(text) -> Column(array<array<float>>)``
of token vectors, e.g. a caller's ``pandas_udf`` wrapping a model (Arrow
batches, one model load per executor), or a ``batched.BatchEncoder``: sub-words of
a vocabulary, padded batches with masks, pooled inside the task.  ``None`` selects the built-in
deterministic hash encoder, pure SQL, so tests and the oracle run offline.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skulink.functions.text import (ENCODER_MAX_TOKENS, remove_stop_words, stop_filtered_text,
                                    tokenize, truncate_tokens)
from skulink.functions.vectors import check_pooling, hash_token_vectors, l2_normalize, pool_tokens
from skulink.operators.batched import BatchEncoder

Encoder = Callable[[Column], Column] | BatchEncoder


def hash_encoder(text: Column, stop_words=None, max_tokens: int = ENCODER_MAX_TOKENS - 2) -> Column:
    """Token vectors of the first ``max_tokens`` stop-filtered tokens.

    The limit is the matched encoder's input limit (X12), a parameter.
    """
    toks = truncate_tokens(remove_stop_words(tokenize(text), stop_words), max_tokens)
    return hash_token_vectors(toks)


def sentence_vector(text: Column, encoder: Encoder | None = None, pooling: str = "mean",
                    stop_words=None, max_tokens: int = ENCODER_MAX_TOKENS - 2) -> Column:
    check_pooling(pooling)
    if isinstance(encoder, BatchEncoder):
        return encoder.vector(remove_stop_words(tokenize(text), stop_words), pooling)
    if encoder is None:
        tv = hash_encoder(text, stop_words, max_tokens)
    else:
        tv = encoder(stop_filtered_text(text, stop_words))
    return l2_normalize(pool_tokens(tv, pooling))


def embed_texts(df: DataFrame, text_col: str, out_col: str = "vec",
                encoder: Encoder | None = None, pooling: str = "mean",
                stop_words=None) -> DataFrame:
    """Add ``out_col`` (unit vector) for ``text_col``; one pass per distinct text."""
    key = F.coalesce(F.col(text_col), F.lit(""))
    distinct = df.select(key.alias("_text")).distinct()
    vecs = distinct.select("_text", sentence_vector(F.col("_text"), encoder, pooling,
                                                    stop_words).alias(out_col))
    return (df.withColumn("_text", key).join(vecs, "_text", "left").drop("_text"))
