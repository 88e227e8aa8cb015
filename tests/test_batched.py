"""Batched encoder: sub-words, limit, length batches, masks."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import catalogue
from skulink.operators import batched as bt
from skulink.operators.embed import embed_texts
from skulink.plans import cascade as cz

NAMES = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "glass", "gl", "##ass", "##a", "##s", "beak", "##er", "b", "##eaker",
         "tube", "##s", "é", "##é"]
VOCAB = bt.Subwords({p: i for i, p in enumerate(NAMES)})


def loader():
    def load():
        """Every place looks at all others: only a right mask makes padding invisible."""
        table = np.random.default_rng(5).normal(size=(200, 8))

        def run(ids, mask):
            x = table[ids]
            score = x @ x.transpose(0, 2, 1) / 3 + np.where(mask[:, None, :] > 0, 0.0, -1e9)
            weight = np.exp(score - score.max(axis=2, keepdims=True))
            return weight / weight.sum(axis=2, keepdims=True) @ x
        return run
    return load            # a function of a function travels to the tasks by value


attention = loader()


def alone(ids, pooling):
    h = attention()(np.array([ids]), np.ones((1, len(ids)), int))[0]
    v = {"mean": h.mean(axis=0), "max": h.max(axis=0), "cls": h[0]}[pooling]
    return v / np.linalg.norm(v)


def names(ids):
    return [NAMES[i] for i in ids]


def test_longest_piece_first_and_unknown_words():
    assert names(VOCAB.split("beaker")) == ["beak", "##er"]        # "beak" before "b" + "##eaker"
    assert names(VOCAB.split("glass")) == ["glass"]
    assert names(VOCAB.split("glassa")) == ["glass", "##a"]
    assert names(VOCAB.split("éé")) == ["é", "##é"]
    for w in ("zebra", "glassz", "[SEP]", "a" * 101):
        assert names(VOCAB.split(w)) == ["[UNK]"], w
    assert VOCAB.split("") == ()


def test_limit_counts_subwords_and_specials():
    words = ["glassa", "beaker", "tube"]
    assert names(VOCAB.encode(words, 128)) == ["[CLS]", "glass", "##a", "beak", "##er", "tube", "[SEP]"]
    assert names(VOCAB.encode(words, 5)) == ["[CLS]", "glass", "##a", "beak", "[SEP]"]
    assert names(VOCAB.encode([], 5)) == ["[CLS]", "[SEP]"]
    r = random.Random(1)
    for _ in range(200):
        ws = [r.choice(["glass", "beaker", "zz", "tubes", "glassass"]) for _ in range(r.randint(0, 9))]
        full = [i for w in ws for i in VOCAB.split(w)]
        assert VOCAB.encode(ws, 7) == [2] + full[:5] + [3]


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bt, "CACHE_WORDS", 3)
    v = bt.Subwords({p: i for i, p in enumerate(NAMES)})
    for w in ("glass", "beaker", "tube", "zz", "glassa", "beaker"):
        assert v.split(w) == VOCAB.split(w) and len(v.cache) <= 3


def test_batches_cover_every_text_once_within_the_bound():
    r = random.Random(3)
    lengths = [r.randint(2, 128) for _ in range(500)] + [128] * 3
    seen = []
    for rows in bt.length_batches(lengths, 256):
        assert len(rows) * max(lengths[i] for i in rows) <= 256
        seen += rows
    assert sorted(seen) == list(range(len(lengths)))
    assert list(bt.length_batches([9, 9], 4)) == [[0], [1]] and list(bt.length_batches([], 4)) == []


@pytest.mark.parametrize("pooling", ["mean", "max", "cls"])
def test_vectors_do_not_depend_on_the_batch(pooling):
    r = random.Random(4)
    ids = [[2] + [r.randint(4, 199) for _ in range(r.randint(0, 60))] + [3] for _ in range(120)]
    want = [alone(x, pooling) for x in ids]
    for size in (1, 100, 1000, 10 ** 6):
        got = bt.encode_batches(attention(), ids, 0, pooling, size)
        assert np.allclose(got, want, atol=1e-9), size


def test_column_of_texts(spark):
    texts = ["glass beaker", "beaker", None, "", "glass beaker", "tube " * 30_000, "unknown words only", "x" * 50_000]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "id int, body string, vec string")
    enc = bt.BatchEncoder(attention, VOCAB, limit=16, batch_tokens=40)
    rows = embed_texts(df.drop("vec").repartition(3), "body", encoder=enc, pooling="max").collect()
    got = {x["id"]: x["vec"] for x in rows}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        ids = VOCAB.encode([w for w in (t or "").split() if w != "only"], 16)
        assert np.allclose(got[i], alone(ids, "max"), atol=1e-9), i
    assert got[0] == got[4] and got[2] == got[3]
    assert embed_texts(df.drop("vec").where(F.lit(False)), "body", encoder=enc).count() == 0
    s = df.select("id", bt.subwords(F.split("body", " "), VOCAB, 5).alias("s")).select("id", "s.*")
    assert {x["id"]: (names(x["ids"]), x["n_subwords"]) for x in s.where("id in (0, 2, 3)").collect()} == {
        0: (["[CLS]", "glass", "beak", "##er", "[SEP]"], 3), 2: (["[CLS]", "[SEP]"], 0), 3: (["[CLS]", "[SEP]"], 0)}
    assert s.where("id = 5").first()["n_subwords"] == 30_000


def test_bad_parameters(spark):
    with pytest.raises(ValueError, match="lacks"):
        bt.Subwords({"a": 0})
    with pytest.raises(ValueError, match="limit"):
        bt.BatchEncoder(attention, VOCAB, limit=2)
    with pytest.raises(ValueError, match="pooling"):
        bt.BatchEncoder(attention, VOCAB).vector(F.col("t"), "sum")
    with pytest.raises(ValueError, match="shape"):
        bt.encode_batches(lambda ids, mask: ids, [[2, 3]], 0, "mean", 10)


def test_cascade_with_a_batched_encoder(spark):
    left = catalogue(spark, [(0, "kilo lima mike", "glass beaker"), (2, "zzz", "")], vendor="Base")
    right = catalogue(spark, [(1, "kilo lima november oscar", "glass beaker"), (3, "q", "")])
    m = cz.match_none(left, right, band="direct", encoder=bt.BatchEncoder(attention, VOCAB))
    got = {r.pos: (r.match_k, r.match_pos) for r in m.collect()}
    assert got[0] == (40, 1) and got[2] == (0, 3)
