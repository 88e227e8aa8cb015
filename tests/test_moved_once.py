"""Whole texts and long join outputs are moved once: plans, and results with shared and missing keys."""

import re

from helpers import SF0001
from pyspark.sql import functions as F
from skulink.operators.candidates import JoinConfig, SetScorer, left_sets, meet, most_shared, postings, right_sets
from skulink.plans import cascade
from skulink.plans import queries as q
from skulink.plans.cascade import match_none, prepare_left
from skulink.sources import fixture as fx
from skulink.sources import pages as pg


def _left(spark, rows):
    return spark.createDataFrame([(p, i, "name", d) for p, i, d in rows],
                                 "pos long, product_id string, product_name string, product_desc string")


def test_own_description_needs_no_join(spark):
    left = prepare_left(_left(spark, [(1, "a", "x"), (2, "b", None), (3, None, "z")]))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert {r.pos: r.desc_by_id for r in left.collect()} == {1: "x", 2: None, 3: None}


def test_shared_ids_take_the_first_description(spark):
    rows = [(5, "a", "late"), (1, "a", "first"), (2, "b", "own"), (3, None, "n"), (4, None, "m"), (6, "c", "x"),
            (6, "c", "y")]
    got = sorted((r.pos, r.product_id or "", r.desc_by_id or "") for r in prepare_left(_left(spark, rows)).collect())
    assert got == [(1, "a", "first"), (2, "b", "own"), (3, "", ""), (4, "", ""), (5, "a", "first"), (6, "c", "x"),
                   (6, "c", "x")]


def test_catalogue_moves_no_word_arrays(spark):
    plan = fx.fixture_catalogue(spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter", 2)[1:]
    # the words of a name's document are cut out between the joins and not split on a document's way to them
    assert "split(" in above and "split(" not in below
    assert "n_text" not in plan.split("Join LeftOuter", 1)[0]


def test_links_are_joined_last(spark):
    pages = spark.createDataFrame(
        [(1, "u1", '<h1>one x</h1><div class="ad">A</div><a href="/two">t</a><a href="/two">t</a>'),
         (2, "u2", '<h1>two x</h1><div class="ad">B</div><div class="ad">C</div>'),
         (3, "u3", '<h1>two y</h1><a href="/one">o</a>')], "page_id long, url string, html string")
    out = pg.two_hop_ids(pages, pg.ListingRule("div", "ad"))
    joins = re.findall(r"Join Inner, \((\w+)#", out._jdf.queryExecution().optimizedPlan().toString())
    assert joins == ["key", "detail_page_id"]
    got = sorted((r.page_id, r["rank"], r.detail_page_id, r.product_id) for r in out.collect())
    assert got == [(1, 1, 2, "B"), (1, 2, 2, "B"), (3, 1, 1, "A")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_rows_are_never_broadcast(spark):
    words = ["a b x", "a b y", "b c z", "a c", "b", "x y z"]
    cat = spark.createDataFrame([("V", i, w.split()) for i, w in enumerate(words)],
                                "vendor string, pos long, words array<string>")
    sc = SetScorer(left_sets(cat), right_sets(cat), JoinConfig(hot_limit=2))
    rows = sc.left.withColumn("vendor", F.lit("V"))
    both = [meet(postings(rows, "lkey", "nl", F.size("toks"), "rkey"),
                 postings(sc.right, "rkey", "nr", F.size("toks"), "lkey"), lambda i, u: 2 * i >= u),
            sc.hot_best(rows), sc.pairs_at_least(30), sc.pairs_in([50])]
    for df in both:
        plan = _plan(df)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    # every set finds itself
    assert {r.lkey for r in sc.best().where("inter = uni").collect()} == {" ".join(sorted(w.split())) for w in words}


def test_cascade_broadcasts_last_ordinals_only(spark):
    cols = "pos long, vendor string, product_id string, product_name string, product_desc string"
    left = spark.createDataFrame([(i, "L", f"p{i}", f"red mug {'abcdef'[i] * 3} handle", "d") for i in range(6)], cols)
    right = spark.createDataFrame([(i, v, f"p{i}", f"red mug {'abcdef'[i] * 3} handle", "e") for i in range(6) for v in "VW"], cols)
    m = match_none(left, right, band="direct")
    plan = _plan(m)
    assert len(re.findall(r"BroadcastExchange", plan)) <= 1 and "SortMergeJoin" in plan
    # tables, not row files: a reader of ids takes no texts
    ids = m.select("pos", "vendor", "match_pos")
    assert "product_desc" not in "".join(re.findall(r"ReadSchema: \S+", _plan(ids)))
    assert sorted((r.vendor, r.pos, r.match_pos) for r in ids.collect()) == [
        (v, i, i) for v in "VW" for i in range(6)]


def test_pair_queries_write_names_only(spark):
    L, R, _ = q._scorer(*q._names(spark, SF0001))
    assert L.columns == R.columns == ["vendor", "pos", "product_name", "words"]


def test_joins_on_words_move_numbers(spark):
    cat = spark.createDataFrame([("V", i, w.split()) for i, w in enumerate(["a b x", "b c z", "a c", "b c a"])],
                                "vendor string, pos long, words array<string>")
    sc = SetScorer(left_sets(cat), right_sets(cat), JoinConfig())
    post = postings(sc.left, "lkey", "nl", F.size("toks"), "rkey")
    kinds = dict(post.dtypes)
    assert kinds["token"] == "bigint" and kinds["ids"] == "array<bigint>" and "toks" not in kinds
    # one number per word, the same on both sides
    pair = lambda sets: {(t, i) for r in sets.collect() for t, i in zip(r.toks, r.ids)}
    assert pair(sc.left) == pair(sc.right) and len({i for _, i in pair(sc.left)}) == 5


def test_right_texts_are_written_for_a_band_only(spark, monkeypatch):
    written = {}
    real = cascade.cut
    monkeypatch.setattr(cascade, "cut", lambda df, name="table", **kw: (
        written.update({name: set(df.columns)}), real(df, name, **kw))[1])
    cols = "vendor string, pos long, product_id string, product_name string, product_desc string"
    left = spark.createDataFrame([("B", 0, "a", "red box", "x")], cols)
    right = spark.createDataFrame([("V", 1, "b", "red box", "y"), ("V", 3, "c", None, None)], cols)
    for band, texts in (("off", set()), ("direct", {"product_name", "product_desc"})):
        rows = match_none(left, right, band=band).collect()
        assert [(r.match_pos, r.match_k, r.score) for r in rows] == [(1, 80, 1.0)]
        assert written["right"] == {"vendor", "pos", "words"} | texts


def test_names_take_their_words_from_the_documents_once(spark):
    sides = fx.fixture_sides(spark, SF0001, 2)
    plain = fx.fixture_left(spark, SF0001), fx.fixture_right(spark, SF0001, 2)
    for side, old in zip(sides, plain):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        assert "split(" not in plan and "n_text" not in plan
        assert sorted(map(str, side.collect())) == sorted(map(str, old.collect()))


def test_joins_test_pairs_in_compiled_conditions(spark):
    # a lambda in a join condition is run uncompiled, for every candidate
    words = ["a b x", "a b y", "b c z", "a c", "b", "x y z"]
    cat = spark.createDataFrame([("V", i, w.split()) for i, w in enumerate(words)],
                                "vendor string, pos long, words array<string>")
    sc = SetScorer(left_sets(cat), right_sets(cat), JoinConfig(hot_limit=2))
    for df in (sc.pairs_at_least(30), sc.pairs_in([50]), sc.rest_pairs(
            sc.left.withColumns({"vendor": F.lit("V"), "inter0": F.lit(1), "uni0": F.lit(9)}))):
        plan = _plan(df)
        joins = [x for x in plan.splitlines() if "SortMergeJoin" in x]
        assert joins and not any("lambda" in x for x in joins)
        # words are compared once a pair, not at every use of their number
        assert len(re.findall(r"array_intersect\(", plan)) == len(joins)


def test_bits_bound_the_shared_words(spark):
    sets = [list(range(i, i + 1 + i % 9)) + [64 * i, 1 << 40] for i in range(40)]
    cat = spark.createDataFrame([("V", i, [f"w{x}" for x in s]) for i, s in enumerate(sets)],
                                "vendor string, pos long, words array<string>")
    sc = SetScorer(left_sets(cat), right_sets(cat), JoinConfig())
    rows = [(set(r.toks), r.sig) for r in sc.left.collect()]
    seen = sc.left.select("toks", "sig").crossJoin(sc.right.select(F.col("toks").alias("r"), F.col("sig").alias("rsig")))
    got = seen.select(most_shared(F.size("toks"), F.col("sig"), F.col("rsig")).alias("most"),
                      F.size(F.array_intersect("toks", "r")).alias("both"), F.size("toks").alias("n")).collect()
    assert len(got) == len(rows) ** 2 and all(r.both <= r.most <= r.n for r in got)
    # sets with one word in common are told from equal ones
    assert sum(r.most < r.n for r in got) > len(got) / 2


def test_catalogues_of_several_vendors_take_their_words_once(spark, monkeypatch):
    names, real = [], fx.fixture_names
    monkeypatch.setattr(fx, "fixture_names", lambda *a: (names.append(a), real(*a))[1])
    for query in (q.q_multi_vendor, lambda *a: q._names(*a)):
        query(spark, SF0001)
        assert len(names) == 1
        names.clear()


def test_a_resumed_run_scores_words_once(spark, monkeypatch):
    made, real = [], SetScorer.__init__
    monkeypatch.setattr(SetScorer, "__init__", lambda self, *a, **kw: (made.append(1), real(self, *a, **kw))[1])
    assert q.q_resume_skip(spark, SF0001).columns == ["vendor", "left_pos", "threshold", "right_product_id", "score"]
    assert len(made) == 1
