"""X12 + E1: a batched encoder with a sub-word limit and padding masks.

A model sees sub-words, not words: each word is split greedily into the longest
pieces of the caller's vocabulary (continuations carry a mark, a word that cannot
be spelled is one unknown piece), the limit counts sub-words and the two specials
around them.  Texts of an Arrow batch are ordered by length and cut into batches
of at most ``batch_tokens`` padded places, so a long text does not stretch short
ones; pooling leaves padded places out, so a text's vector does not depend on
the texts beside it.

Nothing is shuffled: vocabulary and model are bounded parameters that travel to
the tasks, words beyond the limit are cut off before they reach Python (each gives at least
one sub-word), and only the pooled vector comes back.

Defined results: null and empty texts are the two specials alone; a text of any
length keeps its first ``limit - 2`` sub-words, within a word if need be; equal
texts have equal vectors; an empty table stays empty; strings that look like
specials are ordinary text.
"""

from __future__ import annotations

from typing import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from skulink.functions.text import ENCODER_MAX_TOKENS, _c, truncate_tokens
from skulink.functions.vectors import check_pooling

MAX_PIECES = 1_000_000          # a vocabulary travels to every task
CACHE_WORDS = 100_000           # words kept split, per task
BATCH_TOKENS = 16_384           # padded places handed to the model at once

# (ids, mask), both int64 of shape (texts, places) -> vectors of shape (texts, places, dimensions)
Model = Callable[[np.ndarray, np.ndarray], np.ndarray]


class Subwords:
    """Greedy longest-match splitting; ``vocabulary``: piece -> id, specials included."""

    def __init__(self, vocabulary: Mapping[str, int], pad: str = "[PAD]", unknown: str = "[UNK]",
                 first: str = "[CLS]", last: str = "[SEP]", mark: str = "##", max_chars: int = 100):
        if len(vocabulary) > MAX_PIECES:
            raise ValueError(f"{len(vocabulary)} pieces; at most {MAX_PIECES} are shipped to tasks")
        missing = [s for s in (pad, unknown, first, last) if s not in vocabulary]
        if missing:
            raise ValueError(f"the vocabulary lacks {', '.join(missing)}")
        self.pad, self.unknown, self.first, self.last = (vocabulary[s] for s in (pad, unknown, first, last))
        specials = {pad, unknown, first, last}
        self.pieces = {p: i for p, i in vocabulary.items() if p not in specials}
        self.longest = max(map(len, self.pieces), default=0)
        self.mark, self.max_chars = mark, max_chars
        self.cache: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {**self.__dict__, "cache": {}}

    def split(self, word: str) -> tuple[int, ...]:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            got = self.cache[word] = self._spell(word)
        return got

    def _spell(self, word: str) -> tuple[int, ...]:
        if len(word) > self.max_chars:
            return (self.unknown,)
        out, at = [], 0
        while at < len(word):
            head = self.mark if at else ""
            reach = min(len(word), at + self.longest - len(head))
            end = next((e for e in range(reach, at, -1) if head + word[at:e] in self.pieces), None)
            if end is None:
                return (self.unknown,)
            out.append(self.pieces[head + word[at:end]])
            at = end
        return tuple(out)

    def encode(self, words, limit: int) -> list[int]:
        """Ids of a text: the first special, at most ``limit - 2`` sub-words, the last special."""
        out = [self.first]
        for w in words:
            if len(out) >= limit - 1:
                break
            out.extend(self.split(w))
        return out[:limit - 1] + [self.last]


def subwords(tokens, vocabulary: Subwords, limit: int = ENCODER_MAX_TOKENS) -> Column:
    """Struct ``ids`` (specials included, at most ``limit``) and ``n_subwords`` of the whole text."""
    check_limit(limit)

    @F.pandas_udf("struct<ids: array<int>, n_subwords: bigint>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [() if words is None else words for words in batch]
            yield pd.DataFrame({"ids": [vocabulary.encode(t, limit) for t in texts],
                                "n_subwords": [sum(len(vocabulary.split(w)) for w in t) for t in texts]})
    return split(_c(tokens))


def check_limit(limit: int) -> int:
    if limit < 3:
        raise ValueError(f"a limit of {limit} leaves no place between the two specials")
    return limit


def length_batches(lengths: list[int], batch_tokens: int) -> Iterator[list[int]]:
    """Positions by ascending length, cut so that texts x longest stays within ``batch_tokens``.

    A text longer than that is a batch of its own.
    """
    rows: list[int] = []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__):
        if rows and (len(rows) + 1) * lengths[i] > batch_tokens:
            yield rows
            rows = []
        rows.append(i)
    if rows:
        yield rows


def pool_masked(hidden: np.ndarray, mask: np.ndarray, pooling: str) -> np.ndarray:
    """A9 + X13 over a padded batch: unit vectors, padded places left out."""
    if pooling == "cls":
        v = hidden[:, 0, :]
    elif pooling == "max":
        v = np.where(mask[:, :, None] > 0, hidden, -np.inf).max(axis=1)
    else:
        v = (hidden * mask[:, :, None]).sum(axis=1) / mask.sum(axis=1)[:, None]
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


def encode_batches(model: Model, ids: list[list[int]], pad: int, pooling: str, batch_tokens: int) -> list:
    out: list = [None] * len(ids)
    for rows in length_batches([len(x) for x in ids], batch_tokens):
        width = len(ids[rows[-1]])
        places = np.full((len(rows), width), pad, np.int64)
        mask = np.zeros((len(rows), width), np.int64)
        for k, i in enumerate(rows):
            places[k, :len(ids[i])] = ids[i]
            mask[k, :len(ids[i])] = 1
        hidden = np.asarray(model(places, mask), np.float64)
        if hidden.ndim != 3 or hidden.shape[:2] != places.shape:
            raise ValueError(f"the model gave shape {hidden.shape} for {places.shape} places")
        for i, v in zip(rows, pool_masked(hidden, mask, pooling)):
            out[i] = v
    return out


class BatchEncoder:
    """An encoder for ``embed_texts`` and the cascade's ``encoder=``.

    ``load()`` returns the model and runs once per task, so a model is read where it is
    used and is never part of the plan.
    """

    def __init__(self, load: Callable[[], Model], vocabulary: Subwords, limit: int = ENCODER_MAX_TOKENS,
                 batch_tokens: int = BATCH_TOKENS):
        self.load, self.vocabulary = load, vocabulary
        self.limit, self.batch_tokens = check_limit(limit), batch_tokens

    def vector(self, tokens, pooling: str = "mean") -> Column:
        """Unit vector of a column of words."""
        check_pooling(pooling)
        load, vocabulary, limit, batch_tokens = self.load, self.vocabulary, self.limit, self.batch_tokens

        @F.pandas_udf("array<double>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                ids = [vocabulary.encode(() if words is None else words, limit) for words in batch]
                yield pd.Series(encode_batches(model, ids, vocabulary.pad, pooling, batch_tokens), dtype=object)
        return encode(truncate_tokens(tokens, limit - 2))
