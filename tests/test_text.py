"""Scalar functions (X1..X20) on the literal quirk rows."""

from pyspark.sql import functions as F

from skulink.functions import text as tx
from skulink.functions import vectors as vx
import model


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()[0]


def words(spark, name):
    return set(_one(spark, tx.name_words, name))


def test_word_sets_quirks(spark):
    cases = {
        "5 red mL tube": {"tube"},                  # colour then measure removal (Q15)
        "1.5 kg": {"kg"},                           # decimals
        "10x lens 3/4 in": {"10x", "lens", "in"},   # digit glued to letters
        "_red_ x": {"_red_", "x"},                  # underscore is a word character
        "Café 1.5 ml Gray-white": {"Café"},         # Unicode, case-insensitive colours/units
        "250 mL": set(),
        "Beaker beaker": {"Beaker", "beaker"},      # case kept (Q4)
    }
    for name, expected in cases.items():
        assert words(spark, name) == expected, name
        assert model.word_set(name) == expected, name


def test_clean_matches_python(spark):
    names = ["Red Beaker 250 mL Pyrex", "No 5 blue-green 2.5mm wire", "x 12 y 3.5 MM z",
             "SILVER silverware", "Ölflasche 100 ml rot", "", "  spaced   out  "]
    for n in names:
        assert _one(spark, tx.clean_name, n) == model.standard_name(n), n


def test_measures_and_colors(spark):
    m = lambda s: _one(spark, lambda c: F.array_join(tx.measure_set(c), ","), s)
    assert m("250 mL") == m("500 mL") == "|mL"          # integer part ignored (Q3)
    assert m("5 mL") != m("5 ml")                        # unit case kept
    assert m("2.5 mm and 9 ML") == ".5|mm,|ML"
    c = lambda s: _one(spark, lambda x: F.array_join(tx.color_set(x), ","), s)
    assert c("Red and BLUE red") == "blue,red"
    assert c("redwood") == ""
    mv = lambda s: _one(spark, lambda x: F.array_join(tx.measure_set(x, "value"), ","), s)
    assert mv("250 mL") != mv("500 mL")
    assert mv("5 mL") == mv("5 ml")


def test_agreement(spark):
    df = spark.createDataFrame([("red 5 mL", "red 9 mL"), ("red 5 mL", "red 5 mm"),
                                ("red", "blue")], "a string, b string")
    got = [r[0] for r in df.select(tx.agreement(tx.color_set("a"), tx.color_set("b"),
                                                tx.measure_set("a"), tx.measure_set("b"))).collect()]
    assert got == [tx.AGREE_BOTH, tx.AGREE_COLORS_ONLY, tx.AGREE_NONE]


def test_small_text_helpers(spark):
    assert _one(spark, lambda c: tx.text_after(c, "#"), "Item # 12-34") == " 12-34"
    assert _one(spark, lambda c: tx.text_after(c, ": "), "no delimiter") == "no delimiter"
    assert _one(spark, tx.strip_parens, "(AB-1)") == "AB-1"
    assert _one(spark, tx.parse_score_text, "0.375") == 0.375
    df = spark.createDataFrame([(7,), (40,), (0,)], "k int")
    assert [r[0] for r in df.select(tx.threshold_label("k")).collect()] == ["0.07", "0.40", "0.00"]


def test_tokenize_and_stop_words(spark):
    s = "I don't think it's THE best, is it?"
    toks = _one(spark, lambda c: tx.remove_stop_words(tx.tokenize(c)), s)
    assert toks == ["n't", "think", "'s", "best", ",", "?"]
    assert _one(spark, lambda c: tx.tokenize(c), None) == []


def test_tokens_literal(spark):
    cases = {
        "State-of-the-art 1.5 mL, 1,000 units": ["state-of-the-art", "1.5", "ml", ",", "1,000", "units"],
        'He said "no" ("yes")...': ["he", "said", "``", "no", "''", "(", "``", "yes", "''", ")", "..."],
        "I cannot, won't; Cannots": ["i", "can", "not", ",", "wo", "n't", ";", "cannots"],
        "it's we'll -x- a_b": ["it", "'s", "we", "'ll", "-", "x", "-", "a_b"],
        "3. 4, v2.0": ["3", ".", "4", ",", "v2", ".", "0"],
        "": [], " \t\n": [],
    }
    for text, want in cases.items():
        assert _one(spark, lambda c: tx.tokenize(c), text) == want, text
        assert model.tokens(text) == want, text


def test_token_limit_is_a_parameter(spark):
    text = " ".join(f"t{i}" for i in range(300))
    got = lambda n: _one(spark, lambda c: tx.truncate_tokens(tx.tokenize(c), *n), text)
    assert len(got([])) == 126 and got([]) == [f"t{i}" for i in range(126)]
    assert got([7]) == [f"t{i}" for i in range(7)]
    from skulink.operators.embed import sentence_vector
    short = _one(spark, lambda c: sentence_vector(c, max_tokens=5), text)
    five = _one(spark, sentence_vector, "t0 t1 t2 t3 t4")
    assert short == five != _one(spark, sentence_vector, text)


def test_vectors(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0]],)], "tv array<array<double>>")
    r = df.select(vx.pool_tokens("tv", "mean").alias("m"), vx.pool_tokens("tv", "max").alias("x"),
                  vx.pool_tokens("tv", "cls").alias("c")).first()
    assert r.m == [2.0, 3.0] and r.x == [3.0, 4.0] and r.c == [1.0, 2.0]
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>")
    r = df.select(vx.l2_normalize("a").alias("n"), vx.l2_normalize("b").alias("z"),
                  vx.cosine("a", "a").alias("c1"), vx.cosine("a", "b").alias("c0")).first()
    assert r.n == [0.6, 0.8] and r.z == [0.0, 0.0]
    assert abs(r.c1 - 1.0) < 1e-12 and r.c0 == 0.0
    try:
        vx.check_pooling("median")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_hash_encoder_matches_python(spark):
    from skulink.operators.embed import sentence_vector
    texts = ["Glass beaker, heat resistant", "", "the of and", "Ölflasche mit Deckel"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(sentence_vector(F.col("t"))).collect()]
    for t, v in zip(texts, got):
        m = model.vector(t)
        assert len(v) == len(m)
        assert all(abs(a - b) < 1e-12 for a, b in zip(v, m)), t


def test_pool_groups_table_operator(spark):
    from skulink.operators.pooling import pool_groups
    rows = [("a", 2, [1.0, 5.0]), ("a", 1, [3.0, 1.0]), ("b", 7, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "g string, o int, v array<double>")
    got = {s: {r.g: r.pooled for r in pool_groups(df, "g", "o", "v", s).collect()}
           for s in ("mean", "max", "cls")}
    assert got["mean"] == {"a": [2.0, 3.0], "b": [2.0, 2.0]}
    assert got["max"] == {"a": [3.0, 5.0], "b": [2.0, 2.0]}
    assert got["cls"] == {"a": [3.0, 1.0], "b": [2.0, 2.0]}
