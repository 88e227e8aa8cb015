"""Count-only Viterbi over a unigram vocabulary (operator 8).

A word (a run without white space, with the word mark in front) is segmented
into vocabulary pieces of the highest total score.  Only the number of pieces
is wanted, so the dynamic program carries, per end position, the best score
and its piece count instead of a lattice with back pointers.  Aho-Corasick
reads the word once and reports every vocabulary piece ending at each
position, the longest first.

Tie rules are the unigram tokenizer's: candidates for an end position come by
rising start and replace the best only when strictly better, so the longest
piece wins a tie; a character that is no piece by itself costs the lowest
score less 10, is tried last, and neighbouring unknown characters fuse to one
piece.  Scores are added in the same order in double precision.

The vocabulary is a public file's piece list; a piece's score is minus the
logarithm of its position in the list (the file has merge ranks, no
probabilities).  A word's count depends on the word alone, so a worker
remembers counts of words it has seen (bounded; forgetting costs only time).

Defined results: null, empty and blank texts have no words and no tokens;
words of any length are segmented whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import re

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skulink.llm.bpe import chunks_of
from skulink.llm.common import held

MODEL = "piece_bpe_32k.model"
MARK = "▁"           # word mark
UNKNOWN_PENALTY = 10.0    # fixed value of the unigram tokenizer
CACHE_ROWS = 200_000


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(MODEL)


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the file's normal pieces, in file order; entry 0 is <unk>."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    return [("<unk>", 0.0)] + [(p, -math.log(2.0 + i)) for i, p in enumerate(pieces)]


class Counter:
    """Piece counts of words; one per Python worker."""

    def __init__(self, vocab: list[tuple[str, float]]):
        self.auto = ahocorasick.Automaton()
        for piece, score in vocab[1:]:
            self.auto.add_word(piece, (len(piece), score))
        self.auto.make_automaton()
        self.unknown = min(s for _, s in vocab) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    @classmethod
    def of(cls, path: str) -> "Counter":
        return held(("counter", path), lambda: cls(vocabulary(path)))

    def count(self, word: str) -> int:
        """Pieces of the best segmentation of ``word`` (word mark included)."""
        n = len(word)
        ends: list[list] = [[] for _ in range(n)]
        for end, match in self.auto.iter(word):
            ends[end].append(match)     # longest first, that is by rising start
        # best score, pieces and whether the last piece is unknown, per position
        score, pieces, fused = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(n):
            best, single = None, False
            for size, s in ends[end]:
                start = end + 1 - size
                single = single or size == 1
                total = score[start] + s
                if best is None or total > best:
                    best, k, f = total, pieces[start] + 1, False
            if not single:
                total = score[end] + self.unknown
                if best is None or total > best:
                    best, k, f = total, pieces[end] + (not fused[end]), True
            score[end + 1], pieces[end + 1], fused[end + 1] = best, k, f
        return pieces[n]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for w in chunks_of(text):
            k = known.get(w)
            if k is None:
                if len(known) > CACHE_ROWS:
                    known.clear()
                # a mark inside a word starts a new piece of its own
                marked = w if w.startswith(MARK) else MARK + w
                k = known[w] = sum(map(self.count, re.findall(f"{MARK}[^{MARK}]*", marked)))
            total += k
        return total


def counter(path: str | None = None):
    """Column function: text -> number of tokens."""
    at = path or default_path()

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        c = Counter.of(at)
        return pd.Series([c.text(t) for t in texts], dtype="int64")
    return n_tokens


def op8_tokens(spark, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", counter()(F.col("text").cast("string")).alias("n_tokens"))
