"""J1 scoring join against brute force, with and without hot tokens."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from skulink.operators.candidates import JoinConfig, Keys, SetScorer, left_sets, right_sets

BAND = list(range(40, 29, -1))


def _random_sets(rng, n, vocab, hot):
    out = []
    for _ in range(n):
        k = rng.randint(0, 6)
        s = {rng.choice(vocab) for _ in range(k)}
        if rng.random() < 0.6:
            s |= set(rng.sample(hot, rng.randint(1, 2)))
        out.append(sorted(s))
    return out


def _brute(lsets, rrows):
    """best: lkey -> (inter, uni, max pos); band: (lkey, k) -> (min pos, max pos)."""
    best, band, pairs = {}, {}, set()
    for lw in lsets:
        lk = " ".join(sorted(lw))
        b = None
        for pos, rw in rrows:
            i = len(set(lw) & set(rw))
            u = len(set(lw) | set(rw))
            if i == 0:
                continue
            key = (i / u, pos)
            if b is None or key > b[0]:
                b = (key, i, u)
            if 100 * i % u == 0 and 100 * i // u in BAND:
                k = 100 * i // u
                lo, hi = band.get((lk, k), (pos, pos))
                band[(lk, k)] = (min(lo, pos), max(hi, pos))
            if 100 * i >= 25 * u:
                pairs.add((lk, " ".join(sorted(rw)), i, u))
        if b:
            best[lk] = (b[1], b[2], b[0][1])
    return best, band, pairs


@pytest.mark.parametrize("seed,hot_limit", [(1, 100000), (2, 3), (3, 5), (4, 2)])
def test_scorer_matches_brute_force(spark, seed, hot_limit):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(14)]
    hot = ["H1", "H2", "H3"]
    lws = _random_sets(rng, 40, vocab, hot)
    rws = _random_sets(rng, 60, vocab, hot)
    rrows = list(enumerate(rws))
    left = spark.createDataFrame([(i, w) for i, w in enumerate(lws)], "pos long, words array<string>")
    right = spark.createDataFrame([("V", i, w) for i, w in rrows],
                                  "vendor string, pos long, words array<string>")
    cfg = JoinConfig(hot_limit=hot_limit, salt_limit=4)
    sc = SetScorer(left_sets(left), right_sets(right), cfg)
    if hot_limit < 10:
        assert sc.n_hot > 0
    best, band, pairs = _brute({tuple(w) for w in lws}, rrows)
    got_best = {r.lkey: (Fraction(r.inter, r.uni), r.best_pos) for r in sc.best().collect()}
    assert got_best == {k: (Fraction(i, u), p) for k, (i, u, p) in best.items()}
    got_band = {(r.lkey, r.k): (r.first_pos, r.last_pos) for r in sc.band(BAND).collect()}
    assert got_band == band
    got_pairs = {(r.lkey, r.rkey, r.inter, r.uni) for r in sc.pairs_at_least(25).collect()}
    assert got_pairs == pairs


def test_very_long_name_and_a_word_in_every_name(spark):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(40)]
    every = "brand"
    lws = [sorted({every, *rng.sample(vocab, rng.randint(0, 4))}) for _ in range(60)]
    rws = [sorted({every, *rng.sample(vocab, rng.randint(0, 4))}) for _ in range(80)]
    lws.append(sorted(f"long{i}" for i in range(2000)) + ["zz"])
    rws.append(sorted(f"long{i}" for i in range(1, 2000)))
    rrows = list(enumerate(rws))
    left = spark.createDataFrame(list(enumerate(lws)), "pos long, words array<string>")
    right = spark.createDataFrame([("V", i, w) for i, w in rrows],
                                  "vendor string, pos long, words array<string>")
    best, band, _ = _brute({tuple(w) for w in lws}, rrows)
    assert Keys.fit(1000, 10 ** 6).dtype == "long" and Keys.fit(10 ** 6, 10 ** 9).dtype != "long"
    for cfg, keys in ((JoinConfig(), None), (JoinConfig(hot_limit=20, salt_limit=10), Keys())):
        sc = SetScorer(left_sets(left), right_sets(right), cfg)
        sc.keys = keys or sc.keys            # decimals, as much longer names would take
        got = {r.lkey: (Fraction(r.inter, r.uni), r.best_pos) for r in sc.best().collect()}
        assert got == {k: (Fraction(i, u), p) for k, (i, u, p) in best.items()}
        assert {(r.lkey, r.k): (r.first_pos, r.last_pos) for r in sc.band(BAND).collect()} == band


def test_candidate_joins_are_equi_joins(spark):
    sets = [["a", "b"], ["b", "c"], ["a"]]
    left = spark.createDataFrame(list(enumerate(sets)), "pos long, words array<string>")
    right = spark.createDataFrame([("V", i, w) for i, w in enumerate(sets)],
                                  "vendor string, pos long, words array<string>")
    sc = SetScorer(left_sets(left), right_sets(right), JoinConfig(hot_limit=1), band_ks=BAND)
    rows = sc.left.withColumns({"vendor": F.lit("V"), "inter0": F.lit(0), "uni0": F.lit(1)})
    for df in (sc.hot_best(rows), sc.rest_pairs(rows), sc.pairs_at_least(30), sc.pairs_at_least(0)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan, plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_duplicate_right_sets_keep_ordinals(spark):
    left = spark.createDataFrame([(0, ["a", "b"])], "pos long, words array<string>")
    right = spark.createDataFrame([("V", 5, ["a", "b"]), ("V", 9, ["b", "a"]), ("V", 7, ["a"])],
                                  "vendor string, pos long, words array<string>")
    sc = SetScorer(left_sets(left), right_sets(right))
    r = sc.best().first()
    assert (r.inter, r.uni, r.best_pos) == (2, 2, 9)   # tie: the later row wins


def test_no_cross_join_in_plan(spark):
    left = spark.createDataFrame([(0, ["a", "b"])], "pos long, words array<string>")
    right = spark.createDataFrame([("V", 1, ["a"])], "vendor string, pos long, words array<string>")
    sc = SetScorer(left_sets(left), right_sets(right))
    plan = sc.best()._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert F is not None


@pytest.mark.parametrize("seed,min_k", [(5, 25), (6, 50), (7, 80), (8, 1)])
def test_prefix_filter_join_is_exact(spark, seed, min_k):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(10)]
    lws = _random_sets(rng, 50, vocab, ["H1", "H2"])
    rws = _random_sets(rng, 70, vocab, ["H1", "H2"])
    left = spark.createDataFrame([(i, w) for i, w in enumerate(lws)], "pos long, words array<string>")
    right = spark.createDataFrame([("V", i, w) for i, w in enumerate(rws)],
                                  "vendor string, pos long, words array<string>")
    sc = SetScorer(left_sets(left), right_sets(right))
    want = set()
    for lw in {tuple(w) for w in lws}:
        for rw in {tuple(w) for w in rws}:
            i, u = len(set(lw) & set(rw)), len(set(lw) | set(rw))
            if i and 100 * i >= min_k * u:
                want.add((" ".join(sorted(lw)), " ".join(sorted(rw)), i, u))
    got = {(r.lkey, r.rkey, r.inter, r.uni) for r in sc.pairs_at_least(min_k).collect()}
    assert got == want
