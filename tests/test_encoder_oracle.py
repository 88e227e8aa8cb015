"""Pluggable encoder (E1) and the DuckDB oracle on the smallest tables."""

import hashlib
import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import SF0001, catalogue
from skulink.functions.vectors import hash_token_vectors
from skulink.operators.embed import embed_texts
from skulink.plans import cascade as cz


@F.pandas_udf(T.ArrayType(T.ArrayType(T.FloatType())))
def letter_encoder(texts: pd.Series) -> pd.Series:
    """Toy model: one vector per word, counts of a few letters."""
    out = []
    for t in texts:
        out.append([[float(w.count(c)) for c in "aeiost"] for w in t.split()] if t else [])
    return pd.Series(out)


def test_user_encoder_contract(spark):
    df = spark.createDataFrame([("beaker glass",), ("",), ("beaker glass",)], "t string")
    got = embed_texts(df, "t", encoder=letter_encoder).collect()
    v = [r.vec for r in got if r.t]
    assert len(v) == 2 and v[0] == v[1] and abs(sum(x * x for x in v[0]) - 1) < 1e-9
    assert [r.vec for r in got if not r.t] == [[]]


def test_cascade_with_user_encoder_and_options(spark):
    left = catalogue(spark, [(0, "kilo lima mike", "glass beaker"), (2, "zzz", "")], vendor="Base")
    right = catalogue(spark, [(1, "kilo lima november oscar", "glass beaker"), (3, "q", "")])
    m = cz.match_none(left, right, band="direct", encoder=letter_encoder)
    got = {r.pos: (r.match_k, r.match_pos) for r in m.collect()}
    assert got[0] == (40, 1) and got[2] == (0, 3)
    # stop early: weak rows stay unmatched (Q5)
    m2 = cz.match_none(left, right, grid=cz.Grid(stop=0.10), band="off")
    assert {r.pos: r.match_k for r in m2.collect()}[2] is None
    out = cz.attach_rows(m, right, measure_mode="value")
    assert out.count() == 2


ORACLE_QUICK = ["clean_name", "word_set", "colors", "measures", "jaccard_pairs", "best_match_floor",
                "first_in_band", "pool_mean", "l2_normalize", "cascade_none_banded",
                "assisted_band", "listing_two_hop"]


def _digest(rows):
    def norm(v):
        return f"{round(v, 6):.6f}" if isinstance(v, float) else ("NULL" if v is None else str(v))
    return sorted("|".join(norm(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", ORACLE_QUICK if not os.environ.get("SKULINK_FULL_ORACLE")
                         else __import__("__spark_entry__").oracle_sql().keys())
def test_query_matches_duckdb(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF0001)
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    con = duckdb.connect()
    for t in ["part", "documents", "pages", "embeddings"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = [tuple(r[dcols.index(c)] for c in cols) for r in cur.fetchall()]
    assert sorted(dcols) == cols
    assert _digest(srows) == _digest(drows)


def test_digest_bytes_are_read_several_at_a_time(spark):
    words = ["", "a", "shelf", "\u00e4\u00f6", "0" * 300]
    vectors = hash_token_vectors(F.array(*[F.lit(w) for w in words]))
    got = spark.range(1).select(vectors).first()[0]
    want = [[(b - 127.5) / 127.5 for b in hashlib.md5(w.encode()).digest()] for w in words]
    assert got == want                          # the same doubles, not near ones
    assert vectors._jc.toString().lower().count("conv(") <= 3
