"""Helpers of the training-data operators."""

import random
from collections import Counter

from skulink.llm.common import fresh, held, most_frequent


def test_most_frequent_is_a_bounded_top_k(spark):
    r = random.Random(1)
    counts = Counter(int(r.paretovariate(0.6)) for _ in range(20_000))
    df = spark.createDataFrame([(str(k), v) for k, v in counts.items()], "w string, n long").cache()
    ranked = sorted(counts.values(), reverse=True)
    for k in (5, 100, len(counts), 10 ** 6):
        got = most_frequent(df, "w", k)
        assert len(got) <= k and len(got) >= 0.9 * min(k, len(counts))
        assert sum(n for _, n in got) >= 0.99 * sum(ranked[:k])
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
    assert most_frequent(df.limit(0), "w", 10) == []
    ties = spark.range(1000).selectExpr("cast(id as string) w", "1L n")
    assert 60 <= len(most_frequent(ties, "w", 100)) <= 100


def test_one_held_object_and_fresh_names(spark):
    a = held("a", list)
    assert held("a", list) is a
    held("b", dict)
    assert held("a", list) is not a
    df = spark.createDataFrame([(1, 2)], "_x long, _X_ long")
    assert fresh(df, "_x") == "_x__" and fresh(df, "y") == "y"
