"""Toxicity by a classifier chain (operator 6).

Categories are predicted one after the other; the linear model of a category
sees the text features and the probabilities of all categories before it.
While training, those earlier probabilities are out-of-fold predictions, so a
later model learns from inputs as uncertain as it will meet.  The labels
table knows quality and toxicity, from which come four links: low quality,
toxic junk, toxic though well written, toxic.  The last link decides, by the
threshold with the best F1 on its out-of-fold predictions.

Features are rates (per word of the text) of words and of character 5- and
7-grams inside words, so that compounds of abusive stems count in every
language.  Candidates are counted over the labelled sample in Spark and the
``FEATURES`` with the strongest positive association per category stay.

The models are fitted on the driver, on about ``SAMPLE`` labelled documents
(a share of the ids by hash; documented bounds: SAMPLE documents of at most
FEATURES rates each).  Scoring reads whole texts in one scan without
a shuffle.

Defined results: null and word-less texts have no features and get the
models' base rates; documents with contradicting labels count as toxic and of
low quality; without labels, or with one class only, a category's
probability is its base rate and nothing is rejected; repeated rows score
alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skulink.llm.common import fresh, held, release
from skulink.session import cut

SAMPLE = 10_000       # labelled documents the models are fitted on (expected number)
FEATURES = 800        # text features, all categories together
FOLDS = 3
STEPS = 150           # optimiser steps per model
RATE = 30.0           # a feature in every 30th word has the full value 1
SHORT = 20            # texts of fewer words are taken to have so many
COUNTER_ROWS = 60_000
WORDS_KEPT = 100_000

#: category -> SQL over the label columns, in chain order; the last one decides
CHAIN = {"low_quality": "quality = 0",
         "toxic_junk": "toxic = 1 AND quality = 0",
         "toxic_fluent": "toxic = 1 AND quality = 1",
         "toxic": "toxic = 1"}

WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    framed = f"<{word}>"
    return [f"={word}"] + [framed[i:i + n] for n in (5, 7) for i in range(len(framed) - n + 1)]


class Features:
    """Text -> (feature numbers, values); remembers the features of words."""

    def __init__(self, names: list[str]):
        self.index = {f: i for i, f in enumerate(names)}
        self.known: dict[str, tuple[int, ...]] = {}

    @classmethod
    def of(cls, name: str, shared) -> "Features":
        return held(name, lambda: cls(shared.value))

    def word(self, w: str) -> tuple[int, ...]:
        got = self.known.get(w)
        if got is None:
            if len(self.known) > WORDS_KEPT:
                self.known.clear()
            got = self.known[w] = tuple(
                {self.index[f] for f in word_features(w) if f in self.index})
        return got

    def text(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = WORD.findall(text.lower()) if text else []
        counts: dict[int, int] = {}
        for w, k in Counter(words).items():
            for i in self.word(w):
                counts[i] = counts.get(i, 0) + k
        at = np.array(sorted(counts), np.int32)
        k = np.array([counts[i] for i in at], np.float32)
        return at, np.minimum(1.0, RATE * k / max(SHORT, len(words))).astype(np.float32)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
             chain: dict[str, str], sample: int) -> DataFrame:
    """text and one 0/1 column per category of about ``sample`` labelled ids."""
    known = labels.where(F.col(id_col).isNotNull())
    # the same share of ids by hash, whatever the table's size: about `sample` of them
    share = min(1.0, sample / max(1, known.count()))
    picked = F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000)
    truth = (known.groupBy(F.col(id_col).alias("_id"))
             .agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
             .where(picked)
             .select("_id", *[F.coalesce(F.expr(e), F.lit(False)).cast("int").alias(c)
                              for c, e in chain.items()]))
    # about `sample` rows of a few numbers: the documented bound allows a broadcast
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    # one text per id, however often it is repeated
    return cut(texts.join(F.broadcast(truth), "_id").groupBy("_id", *chain)
               .agg(F.min("text").alias("text")).drop("_id"), "toxicity-sample")


def strongest(rows: DataFrame, categories: list[str], total: int) -> list[str]:
    """Features whose presence goes with a category, by chi-square of the excess."""
    def count(batches):
        release()
        n: dict[str, list[int]] = {}
        flush = lambda: pd.DataFrame(
            [(f, *v) for f, v in n.items()], columns=["f", "n", *categories])
        for pdf in batches:
            for text, *ys in pdf[["text", *categories]].itertuples(index=False):
                seen = {f for w in set(WORD.findall(text.lower() if text else ""))
                        for f in word_features(w)}
                for f in seen:
                    v = n.get(f)
                    if v is None:
                        v = n[f] = [0] * (1 + len(categories))
                    v[0] += 1
                    for i, y in enumerate(ys):
                        v[i + 1] += y
                if len(n) > COUNTER_ROWS:
                    yield flush()
                    n.clear()
        yield flush()

    schema = "f string, n long, " + ", ".join(f"{c} long" for c in categories)
    sums = rows.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    if not sums["n"]:
        return []
    counted = cut(rows.repartition(24).mapInPandas(count, schema).groupBy("f").agg(
        F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in categories]).where("n >= 4"),
        "toxicity-features")
    names: list[str] = []
    for c in categories:
        expected = F.col("n") * F.lit((sums[c] or 0) / sums["n"])
        top = (counted.where(F.col(c) > expected)
               .withColumn("chi", (F.col(c) - expected) ** 2 / expected)
               .orderBy(F.desc("chi"), "f").limit(total // len(categories)).collect())
        names += [r["f"] for r in top]
    return list(dict.fromkeys(names))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Adam; the last weight is the intercept."""
    rate = y.mean() if len(y) else 0.0
    base = np.log((rate + 1e-4) / (1 - rate + 1e-4))
    w = np.zeros(x.shape[1] + 1, np.float64)
    w[-1] = base
    if rate in (0.0, 1.0):
        return w
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, STEPS + 1):
        miss = predict(w, x) - y
        g = np.append(x.T @ miss.astype(np.float32), miss.sum()) / len(y)
        g[:-1] += 1e-4 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.08 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    z = x @ w[:-1].astype(np.float32) + w[-1]
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_chain(x: np.ndarray, ys: np.ndarray, fold: np.ndarray) -> tuple[list, np.ndarray]:
    """Models in chain order and their out-of-fold probabilities."""
    models, earlier = [], np.zeros((len(x), 0), np.float32)
    for c in range(ys.shape[1]):
        seen = np.hstack([x, earlier])
        out = np.zeros(len(x))
        for k in range(FOLDS):
            held = fold == k
            out[held] = predict(fit(seen[~held], ys[~held, c]), seen[held])
        models.append(fit(seen, ys[:, c]))
        earlier = np.hstack([earlier, out[:, None].astype(np.float32)])
    return models, earlier


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Threshold of the best F1; above every probability where one class is missing."""
    if not len(y) or y.min() == y.max():
        return 2.0
    grid = np.round(np.arange(0.2, 0.85, 0.05), 2)
    f1 = [2 * ((p >= t) & (y == 1)).sum() / max(1, ((p >= t).sum() + (y == 1).sum()))
          for t in grid]
    return float(grid[int(np.argmax(f1))])


class Chain:
    """A fitted chain; ``column()`` scores a text column."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", chain: dict[str, str] = CHAIN, sample: int = SAMPLE,
                 features: int = FEATURES):
        self.categories = list(chain)
        rows = labelled(docs, labels, id_col, text_col, chain, sample)
        names = strongest(rows, self.categories, features)
        self.name = uuid.uuid4().hex
        self.shared = docs.sparkSession.sparkContext.broadcast(names)
        x, ys, fold = self.matrix(rows, len(names))
        self.models, oof = fit_chain(x, ys, fold)
        self.threshold = best_threshold(oof[:, -1], ys[:, -1])
        self.oof, self.truth = oof, ys

    def matrix(self, rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        name, shared, cats = self.name, self.shared, self.categories

        @F.pandas_udf("at array<int>, val array<float>")
        def features(texts: pd.Series) -> pd.DataFrame:
            feats = Features.of(name, shared)
            return pd.DataFrame([feats.text(t) for t in texts], columns=["at", "val"])

        # bounded by the sample and the number of features
        got = (rows.select(features("text").alias("f"), *cats,
                           F.pmod(F.xxhash64("text"), F.lit(FOLDS)).alias("fold"))
               .select("f.at", "f.val", "fold", *cats).collect())
        x = np.zeros((len(got), n), np.float32)
        for i, r in enumerate(got):
            x[i, r["at"]] = r["val"]
        ys = np.array([[r[c] for c in cats] for r in got], np.float64).reshape(len(got), len(cats))
        return x, ys, np.array([r["fold"] for r in got])

    def column(self):
        """Column function: text -> struct of one probability per category."""
        name, shared, models = self.name, self.shared, self.models
        cats = self.categories

        @F.pandas_udf(", ".join(f"{c} double" for c in cats))
        def score(texts: pd.Series) -> pd.DataFrame:
            feats = Features.of(name, shared)
            n = len(feats.index)
            out = np.zeros((len(texts), len(cats)))
            for i, t in enumerate(texts):
                at, val = feats.text(t)
                for c, w in enumerate(models):
                    z = w[-1] + (val * w[at]).sum() + (out[i, :c] * w[n:n + c]).sum()
                    out[i, c] = 1.0 / (1.0 + np.exp(-min(30.0, max(-30.0, z))))
            return pd.DataFrame(out, columns=cats)
        return score


def scored(docs: DataFrame, labels: DataFrame, out_col: str, id_col: str = "doc_id",
           text_col: str = "text", **limits) -> tuple[DataFrame, float]:
    """``docs`` with a struct column of probabilities, and the rejection threshold."""
    chain = Chain(docs, labels, id_col, text_col, **limits)
    return docs.withColumn(out_col, chain.column()(F.col(text_col).cast("string"))), chain.threshold


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Category probabilities and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out, threshold = scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "p")
    return out.select("doc_id", *[F.round(F.col(f"p.{c}"), 6).alias(f"p_{c}") for c in CHAIN],
                      (F.col("p.toxic") >= threshold).alias("rejected"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the chain rejects go."""
    p = fresh(docs, "_p")
    out, threshold = scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), p)
    return out.where(F.col(f"{p}.toxic") < threshold).drop(p)
