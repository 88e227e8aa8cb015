"""Pairs whose common words are all frequent: against brute force, and how many rows their joins make."""

import random

import pytest
from pyspark.sql import functions as F

from skulink.operators.candidates import (JoinConfig, SetScorer, exact_common, least_common, left_sets,
                                          right_sets, subset_pairs, subsets_of)

HOT = [f"H{i}" for i in range(8)]


def _scorer(spark, lws, rws, cfg, **more):
    left = spark.createDataFrame(list(enumerate(lws)), "pos long, words array<string>")
    right = spark.createDataFrame([("V" if i % 3 else "W", i, w) for i, w in enumerate(rws)],
                                  "vendor string, pos long, words array<string>")
    return SetScorer(left_sets(left), right_sets(right), cfg, **more)


def _names(rng, n):
    return [sorted({*rng.sample(HOT, rng.randint(0, 7)), *(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(0, 3)))})
            for _ in range(n)]


def _pairs(lws, rws):
    for i, r in enumerate(rws):
        for w in {tuple(x) for x in lws}:
            common = len(set(w) & set(r))
            if common:
                yield "V" if i % 3 else "W", " ".join(w), " ".join(r), common, len(set(w) | set(r)), i


@pytest.mark.parametrize("seed,subset_words", [(1, 10), (2, 3), (3, 1)])
def test_hot_pairs_match_brute_force(spark, seed, subset_words):
    rng = random.Random(seed)
    lws, rws = _names(rng, 50), _names(rng, 60)
    cfg = JoinConfig(hot_limit=6, salt_limit=20, max_subset_words=subset_words)
    sc = _scorer(spark, lws, rws, cfg)
    assert sc.n_hot >= 5
    want = list(_pairs(lws, rws))
    for k in (30, 41, 80):
        got = [(r.vendor, r.lkey, r.rkey, r.inter, r.uni) for r in sc.pairs_at_least(k).collect()]
        assert sorted(got) == sorted({p[:5] for p in want if 100 * p[3] >= k * p[4]})
    ks = list(range(40, 29, -1))
    got = [(r.vendor, r.lkey, r.rkey, r.k) for r in sc.pairs_in(ks).collect()]
    assert sorted(got) == sorted({(*p[:3], 100 * p[3] // p[4]) for p in want
                                  if 100 * p[3] % p[4] == 0 and 100 * p[3] // p[4] in ks})
    best: dict = {}
    for vendor, w, _, inter, uni, pos in want:
        best[vendor, w] = max(best.get((vendor, w), (0, 0)), (inter / uni, pos))
    assert {(r.vendor, r.lkey): (r.inter / r.uni, r.best_pos) for r in sc.best().collect()} == best
    # a scorer with a settled score gives the band of the sets that stay below it
    some = _scorer(spark, lws, rws, cfg, band_ks=ks, settled_k=41)
    low = {x for x, (score, _) in best.items() if score < 0.41}
    got = {(r.vendor, r.lkey, r.k, r.first_pos, r.last_pos) for r in some.band(ks).collect()}
    band = {(r.vendor, r.lkey, r.k, r.first_pos, r.last_pos) for r in sc.band(ks).collect()}
    assert got == {r for r in band if r[:2] in low}


def test_frequent_words_are_not_paired_one_by_one(spark):
    # every name holds two of the frequent words, none reaches 0.30 with another
    lws = [["H0", "H1", *(f"l{i}_{j}" for j in range(6))] for i in range(60)]
    rws = [["H0", "H1", *(f"r{i}_{j}" for j in range(6))] for i in range(60)]
    sc = _scorer(spark, lws, rws, JoinConfig(hot_limit=5))
    common = least_common(30, 100, sc.bounds, sc.cfg)
    assert max(common.values()) <= 2 and 16 not in common      # eight and eight words have to share four
    assert exact_common([30, 40], 100, sc.bounds, sc.cfg).get(16) is None
    assert subset_pairs(sc.left, sc.right, common, sc.cfg).count() == 0
    assert sc.pairs_at_least(30).count() == 0
    assert {(r.inter, r.uni) for r in sc.best().collect()} == {(2, 14)}
    found = spark.range(1).select(subsets_of(F.array(F.lit("a"), F.lit("b"))).alias("x")).first()["x"]
    assert sorted((x.s, x.h) for x in found) == [("a", 1), ("a b", 2), ("b", 1)]
