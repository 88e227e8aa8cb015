"""The sentence-aware tokeniser: abbreviations learnt from a corpus."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from skulink.operators import sentences as sn

WORDS = ("the old house stood near river while people walked home with bread under trees and birds sang "
         "songs about summer rain falling over quiet hills").split()


def corpus(n: int = 400, seed: int = 2) -> list[str]:
    r = random.Random(seed)
    out = []
    for _ in range(n):
        text = []
        for _ in range(r.randint(1, 5)):
            s = [r.choice(WORDS) for _ in range(r.randint(4, 9))]
            s.insert(r.randrange(1, len(s)), r.choice(["Dr. Smith", "(e.g. bread)", "approx. two", "in the U.S. too"]))
            text.append(" ".join(s).capitalize() + r.choice(".....!?"))
        out.append(" ".join(text))
    return out


def brute_scores(texts: list[str]) -> dict[str, tuple[int, int, float]]:
    """Scores from the definition, word by word."""
    pointed, plain = Counter(), Counter()
    for w in (w for t in texts for w in (t or "").lower().split()):
        core = w.rstrip("\"')]},;:!?")
        bare = re.sub(r"^[\W_]+", "", core)
        if core.endswith(".") and not core.endswith(".."):
            kind, t = pointed, bare[:-1]
        else:
            kind, t = plain, re.sub(r"[\W_]+$", "", bare)
        if re.search(r"[^\W\d_]", t):
            kind[t] += 1
    total = sum(pointed.values()) + sum(plain.values())
    p = sum(pointed.values()) / total
    out = {}
    for t, a in pointed.items():
        b = plain[t]
        null = a * math.log(p) + b * math.log(1 - p)
        own = a * math.log(0.99) + b * math.log(0.01)
        size = len(t.replace(".", ""))
        out[t] = (a, b, max(0.0, -2 * (null - own) * math.exp(-size) * (t.count(".") + 1) * size ** -float(b)))
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def test_scores_equal_the_definition(spark):
    texts = corpus()
    got = {r["type"]: (r["n_pointed"], r["n_plain"], r["score"]) for r in sn.pointed_types(frame(spark, texts)).collect()}
    want = brute_scores(texts)
    assert got.keys() == want.keys()
    for t, (a, b, s) in want.items():
        assert got[t][:2] == (a, b) and math.isclose(got[t][2], s, rel_tol=1e-9, abs_tol=1e-12), t


def test_abbreviations_keep_their_point(spark):
    docs = frame(spark, corpus())
    known = sn.abbreviations(docs)
    found = {r["type"] for r in known.collect()}
    assert {"dr", "e.g", "u.s"} <= found and not found & set(WORDS)
    cases = [("Dr. Smith left.", ["dr.", "smith", "left", "."]),
             ("He left. Dr. Smith, (e.g. here) stayed.",
              ["he", "left", ".", "dr.", "smith", ",", "(", "e.g.", "here", ")", "stayed", "."]),
             ("It is in the U.S., v2.0 or 1,000.5. \"No.\" I can't... cannot Dr.",
              ["it", "is", "in", "the", "u.s.", ",", "v2.0", "or", "1,000.5", ".", "``", "no", ".", "''",
               "i", "ca", "n't", "...", "can", "not", "dr", "."]),
             ("a.b.c.d e.", ["a.b.c.d", "e", "."]), (None, []), ("", []), (" \t\n", []), ("...", ["..."]), ("Dr.", ["dr", "."])]
    rows = [(i % 3 if i % 3 else None, text, "x", len(want)) for i, (text, want) in enumerate(cases)] * 2
    got = sn.tokenize_sentences(
        spark.createDataFrame(rows, "doc long, body string, tokens string, n int"), "doc", "body", known=known)
    assert got.columns == ["doc", "body", "n", "tokens"] and got.count() == len(rows)
    want = {text: tokens for text, tokens in cases}
    for r in got.collect():
        assert r["tokens"] == want[r["body"]], r["body"]


def test_known_by_a_join_beyond_the_bound(spark):
    docs = frame(spark, corpus(60) + ["Dr. " * 30_000 + "x."])
    by = [sn.tokenize_sentences(docs, "id", max_broadcast_rows=n).orderBy("id").collect() for n in (0, 1000)]
    assert by[0] == by[1]
    assert by[0][-1]["tokens"] == ["dr."] * 30_000 + ["x", "."]


def test_empty_corpus(spark):
    docs = frame(spark, ["a"]).where(F.lit(False))
    assert sn.pointed_types(docs).count() == sn.tokenize_sentences(docs, "id").count() == 0
    none = frame(spark, [None, "", "no points here"])
    assert sn.abbreviations(none).count() == 0
    assert [r["tokens"] for r in sn.tokenize_sentences(none, "id").orderBy("id").collect()] == [
        [], [], ["no", "points", "here"]]


def test_types_are_found_once_per_word(spark):
    docs = frame(spark, ["Dr. Who (u.s.) who, WHO."] * 3 + [None, "dr. dr 12."])
    counts = sn.type_counts(docs)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" in plan and "Generate" not in plan      # words are read, not split again
    assert {r["type"]: (r["n_pointed"], r["n_plain"]) for r in counts.collect()} == {
        "dr": (4, 1), "who": (3, 6), "u.s": (3, 0)}
