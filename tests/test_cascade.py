"""Cascade (I1..I7) against the literal model of the sequential job."""

import pytest
from pyspark.sql import functions as F

import model
from helpers import SF0001, catalogue
from skulink.operators.candidates import SetScorer
from skulink.plans import cascade as cz
from skulink.plans.exclusion import match_excluding
from skulink.session import cut
from skulink.sources import fixture as fx


def _rows(df):
    return [r.asDict() for r in df.collect()]


def _spark_result(m):
    return {r.pos: (r.match_k, r.match_pos, r.score) for r in m.collect() if r.match_k is not None}


def _same(got, want):
    assert set(got) == set(want), (sorted(set(got) ^ set(want)))[:10]
    for p in want:
        gk, gp, gs = got[p]
        wk, wp, ws = want[p]
        assert (gk, gp) == (wk, wp), (p, got[p], want[p])
        assert abs(gs - ws) < 1e-9, (p, got[p], want[p])


@pytest.fixture(scope="module")
def fixture_rows(spark):
    # built once: every test reads the written tables
    L, R = cut(fx.fixture_left(spark, SF0001)), cut(fx.fixture_right(spark, SF0001))
    return L, R, _rows(L), _rows(R)


@pytest.mark.parametrize("band", ["off", "direct"])
def test_closed_form_matches_model(spark, fixture_rows, band):
    L, R, lrows, rrows = fixture_rows
    want = model.run(lrows, rrows, mode=band, policy="none")
    _same(_spark_result(cz.match_none(L, R, band=band)), want)


def test_assisted_matches_model(spark, fixture_rows):
    L, R, lrows, rrows = fixture_rows
    hits = fx.fixture_hits(spark, SF0001)
    hd = {}
    for h in sorted(hits.collect(), key=lambda r: r["rank"]):
        hd.setdefault(h.query_key, []).append(h.product_id)
    want = model.run(lrows, rrows, mode="assisted", policy="none", hits=hd)
    got = cz.match_none(L, R, band="assisted", hits=hits, hit_key="product_id")
    _same(_spark_result(got), want)


@pytest.mark.parametrize("policy", ["matched", "last_scanned"])
def test_exclusion_policies_match_model(spark, fixture_rows, policy):
    L, R, lrows, rrows = fixture_rows
    grid = cz.Grid(step=0.05)
    want = model.run(lrows, rrows, step=5, mode="direct", policy=policy)
    got = match_excluding(L, R, policy, grid=grid, band="direct")
    _same(_spark_result(got), want)


def test_quirk_rows(spark):
    # left 0: best 3/8 -> band rejects -> matched at 0.29 (score .375)
    # left 2: exact 2/5 in the band; same description -> high cosine -> matched at 0.40
    # left 4: no shared word -> last right row at 0.00, score 0
    # left 6: 4 of 5 words -> matched at 0.80
    # left 8: tie between right 11 and 13 outside the band -> higher pos wins
    left = catalogue(spark, [
        (0, "alpha beta gamma delta epsi", "d0"),
        (2, "kilo lima mike", "same words here"),
        (4, "zzz", "d4"),
        (6, "one two three four five", "d6"),
        (8, "tie uno dos", "d8"),
    ], vendor="Base")
    right = catalogue(spark, [
        (1, "alpha beta gamma zeta eta theta", "x1"),
        (3, "kilo lima november oscar", "same words here"),
        (5, "one two three four", "x5"),
        (11, "tie uno tres", "x11"),
        (13, "tie uno cuatro", "x13"),
        (15, "unrelated", "x15"),
    ])
    m = _spark_result(cz.match_none(left, right, band="direct"))
    assert m[0][:2] == (29, 1) and abs(m[0][2] - 0.375) < 1e-12
    assert m[2][:2] == (40, 3) and m[2][2] > 0.4
    assert m[4] == (0, 15, 0.0)
    assert m[6][:2] == (80, 5)
    assert m[8][1] == 13
    want = model.run(_rows(left), _rows(right), mode="direct")
    _same(m, want)


def test_empty_right_catalogue_gives_no_vendor_rows(spark):
    left = catalogue(spark, [(0, "a b")], vendor="Base")
    right = catalogue(spark, [(1, "a b")]).where(F.lit(False))
    assert cz.match_none(left, right, band="off").count() == 0


def test_round_expansion_and_sentinel(spark):
    left = catalogue(spark, [(0, "one two three four five"), (2, "zzz")], vendor="Base")
    right = catalogue(spark, [(1, "one two three four"), (3, "other")])
    grid = cz.Grid(step=0.1)
    out = cz.attach_rows(cz.match_none(left, right, grid=grid, band="off"), right)
    rnd = cz.round_output(out, grid).orderBy("left_pos", F.col("k").desc()).collect()
    a = [r for r in rnd if r.left_pos == 0]
    assert [r.threshold for r in a] == ["0.80"] and a[0].right_product_id == "P1"
    b = [r for r in rnd if r.left_pos == 2]
    assert len(b) == 9 and b[-1].threshold == "0.00" and b[-1].right_product_id == "P3"
    assert all(r.right_product_name == "No good match found (Low match score)" for r in b[:-1])
    assert all(r.score == 0.0 for r in b)


def test_grid_validation():
    assert cz.Grid().ks[0] == 80 and cz.Grid().ks[-1] == 0 and len(cz.Grid().ks) == 81
    assert cz.Grid().band_ks == list(range(40, 29, -1))
    assert cz.Grid(step=0.1).band_ks == [40, 30]
    for bad in (0.0, -0.01, 0.005):
        with pytest.raises(ValueError):
            cz.Grid(step=bad)


def test_require_agreement(spark):
    left = catalogue(spark, [(0, "red tube 5 mL"), (2, "red tube 5 mm"), (4, "blue tube")], vendor="Base")
    right = catalogue(spark, [(1, "red tube 9 mL")])
    out = cz.attach_rows(cz.match_none(left, right, band="off"), right)
    assert sorted(r.left_pos for r in cz.require_agreement(out).collect()) == [0]
    assert sorted(r.left_pos for r in cz.require_agreement(out, "colors").collect()) == [0, 2]


@pytest.mark.parametrize("policy", ["matched", "last_scanned"])
def test_assisted_exclusion_matches_model(spark, fixture_rows, policy):
    L, R, lrows, rrows = fixture_rows
    hits = fx.fixture_hits(spark, SF0001)
    hd = {}
    for h in sorted(hits.collect(), key=lambda r: r["rank"]):
        hd.setdefault(h.query_key, []).append(h.product_id)
    want = model.run(lrows, rrows, step=5, mode="assisted", policy=policy, hits=hd)
    got = match_excluding(L, R, policy, grid=cz.Grid(step=0.05), band="assisted", hits=hits,
                          hit_key="product_id")
    _same(_spark_result(got), want)


def test_duplicate_left_id_uses_first_description(spark):
    # both left rows share id P0: the band scores the first row's description
    left = catalogue(spark, [(0, "kilo lima mike", "glass beaker heat", "P0"),
                             (2, "kilo lima mike", "unrelated words only", "P0")], vendor="Base")
    right = catalogue(spark, [(1, "kilo lima november oscar", "glass beaker heat")])
    got = _spark_result(cz.match_none(left, right, band="direct"))
    want = model.run(_rows(left), _rows(right), mode="direct")
    _same(got, want)
    assert got[0] == got[2]


@pytest.mark.parametrize("policy", ["matched", "last_scanned"])
def test_duplicate_right_rows_leave_together(spark, policy):
    left = catalogue(spark, [(0, "alpha beta"), (2, "alpha beta"), (4, "alpha gamma"),
                             (6, "delta"), (8, "alpha beta gamma")], vendor="Base")
    rows = [(1, "alpha beta", "d", "X1"), (3, "alpha beta", "d", "X1"), (5, "alpha gamma"),
            (7, "delta epsilon"), (9, "zeta")]
    right = catalogue(spark, rows)
    grid = cz.Grid(step=0.1)
    got = _spark_result(match_excluding(left, right, policy, grid=grid, band="direct"))
    want = model.run(_rows(left), _rows(right), step=10, mode="direct", policy=policy)
    _same(got, want)


def test_lost_best_rows_are_scored_again_in_their_round_only(spark, monkeypatch):
    # left 4 loses its best row in round 33 and its second best in round 28, but its own round is 12
    left = catalogue(spark, [(0, "a aone atwo"), (2, "b bone btwo"), (4, "a b yone ytwo")], vendor="Base")
    right = catalogue(spark, [(1, "a aone p q r"), (3, "b bone s t u v"), (5, "yone f g h i j k"), (7, "zzz")])
    asked, real = [], SetScorer.rescored

    def rescored(self, rows):
        asked.extend(r.lkey for r in rows.collect())
        return real(self, rows)

    monkeypatch.setattr(SetScorer, "rescored", rescored)
    got = _spark_result(match_excluding(left, right, "matched", band="off"))
    _same(got, model.run(_rows(left), _rows(right), mode="off", policy="matched"))
    assert [got[p][:2] for p in (0, 2, 4)] == [(33, 1), (28, 3), (10, 5)]
    assert asked == ["a b yone ytwo"]


def test_rows_of_a_repeated_ordinal_come_out_once_a_round_waited(spark):
    left = catalogue(spark, [(0, "a aone atwo"), (2, "b bone btwo"), (4, "yone ytwo")], vendor="Base")
    right = catalogue(spark, [(1, "a aone p q r"), (3, "b bone s t u v"), (5, "yone f g h i j k"),
                              (5, "yone f g h i j k")])
    m = match_excluding(left, right, "matched", band="off")
    got = {(r.pos, r.match_k, r.match_pos): r["count"] for r in m.groupBy("pos", "match_k", "match_pos").count().collect()}
    assert got == {(0, 33, 1): 1, (2, 28, 3): 1, (4, 12, 5): 8}
