"""Quality rules with risk-controlled thresholds (operator 3, built-in functions only).

Each rule is a score of the text (symbols per word, characters per word,
repeated lines, repeated three-word windows) and rejects a document whose
score exceeds the rule's cutoff.  Cutoffs are not guessed: on the labelled
holdout, per stratum (``lang``), a candidate cutoff is certified when the
exact binomial test refutes "it rejects more than its share of the good
documents": with k false rejections among n good documents,
P(Binomial(n, ALPHA / rules) <= k) <= DELTA / m.  A document goes if any rule
rejects it, so each of the rules gets an equal share of the stratum's limit ALPHA, and m
is the number of tests made in all strata together (Bonferroni): with probability
1 - DELTA no stratum loses more than ALPHA of its good documents to all rules together.  A rule takes its strictest
certified cutoff, provided that it catches bad documents at a higher rate than
good ones; a stratum with too few labels certifies nothing and keeps
everything that passes the base rules.

The rules read one document at a time and the text is scanned once; the
scores go to a table in the shared folder, from which thresholds and verdicts
come.  Counts are aggregated before they are shuffled; the cutoff table has a
row per stratum.

Defined results: null and empty text have no words and fail the base rules;
a null stratum is a stratum; documents with contradicting labels count as
labelled bad; repeated rows are judged alike; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skulink.session import cut

ALPHA = 0.02      # share of good documents that all rules together may reject in a stratum
DELTA = 0.05      # chance that any certified cutoff breaks that limit
GRID = 32         # candidate cutoffs per rule
# score ranges of the candidate grids: symbols per word, code points per word,
# share of repeated lines, share of words in repeated windows
RULES = {"symbol_rate": (0.0, 1.6), "word_length": (4.0, 20.0),
         "dup_line_rate": (0.0, 0.8), "repeat_rate": (0.0, 0.5)}

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def let(value: Column, body) -> Column:
    """Bind ``value`` once: inside lambdas Spark would compute it per use."""
    return F.transform(F.array(value), body)[0]


def word_array(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Windows sort with their positions, equal neighbours give the positions of
    repeated windows, and sorted positions give the size of their union.
    """
    def positions(w):
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("t"),
                               i.alias("i")))
        # neighbours meet in a fold over the sorted windows; the state holds the
        # last window, so nothing is looked up by index
        return F.sort_array(windows)

    def repeated(s):
        n = F.size(s)
        return F.sort_array(F.filter(
            F.transform(s, lambda x, j: F.when(
                ((j > 0) & (F.get(s, j - 1)["t"] == x["t"]))
                | ((j < n - 1) & (F.get(s, j + 1)["t"] == x["t"])), x["i"])),
            lambda p: p.isNotNull()))

    def union_size(p):
        return F.aggregate(
            p, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
            lambda a, x: F.struct(x.alias("last"),
                                  (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")),
            lambda a: a["n"])

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(
        let(words, lambda w: let(positions(w), lambda s: let(repeated(s), union_size))))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             stratum_col: str = "lang") -> DataFrame:
    """id, stratum and the counts of every document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    counted = let(word_array(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
        repeat_words(w).cast("long").alias("n_repeat_words")))
    return (docs.select(F.col(id_col).alias("id"),
                        F.col(stratum_col).cast("string").alias("stratum"),
                        counted.alias("c"),
                        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                        dup_lines(text).cast("long").alias("n_dup_lines"),
                        F.size(F.split(text, "\n")).cast("long").alias("n_lines"))
            .select("id", "stratum", "c.n_words", "c.word_chars", "n_symbols", "n_dup_lines",
                    "c.n_repeat_words", "n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def scores() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {"symbol_rate": F.col("n_symbols") / n, "word_length": F.col("word_chars") / n,
            "dup_line_rate": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "repeat_rate": F.col("n_repeat_words") / n}


def ln_gamma(x: Column) -> Column:
    """Stirling's series at x + 8, stepped back by the recurrence (1e-13 relative)."""
    z = x + 8.0
    series = ((z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi)
              + 1.0 / (12.0 * z) - 1.0 / (360.0 * z * z * z)
              + 1.0 / (1260.0 * z * z * z * z * z))
    steps = F.log(x)
    for i in range(1, 8):
        steps = steps + F.log(x + float(i))
    return series - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), exact up to rounding; 1 where k is at or above the mean.

    Terms are summed downwards from k by their ratio, which is below 1 there;
    40 standard deviations hold every term that a double can see.
    """
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(ln_gamma(n + 1.0) - ln_gamma(k + 1.0) - ln_gamma(n - k + 1.0)
                + k * math.log(p) + (n - k) * math.log1p(-p))
    steps = F.least(k, F.ceil(40.0 * F.sqrt(n * p) + 40.0)).cast("int")
    tail = F.when(steps < 1, F.lit(1.0)).otherwise(F.aggregate(
        F.sequence(F.lit(1), F.greatest(steps, F.lit(1))),
        F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
        lambda a, j: let(a["t"] * (k - j + 1.0) * (1.0 - p) / ((n - k + j) * p),
                         lambda t: F.struct(t.alias("t"), (a["s"] + t).alias("s"))),
        lambda a: a["s"]))
    return F.when(n < 1, F.lit(1.0)).when(k >= n * p, F.lit(1.0)).otherwise(top * tail)


def thresholds(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id",
               label_col: str = "quality", alpha: float = ALPHA, delta: float = DELTA,
               grid: int = GRID) -> DataFrame:
    """stratum and one cutoff per rule (null: none certified)."""
    truth = (labels.where(F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("good")))
    held = (measured.where(~base_failed()).join(truth, "id")
            .select("stratum", "good", F.explode(F.array(*[
                F.struct(F.lit(r).alias("rule"), v.alias("score"),
                         # the largest grid step whose cutoff the score exceeds
                         F.greatest(F.lit(-1), F.least(F.lit(grid - 1), (F.ceil(
                             (v - RULES[r][0]) / ((RULES[r][1] - RULES[r][0]) / grid)) - 1)
                             )).cast("int").alias("above"))
                for r, v in scores().items()])).alias("x")))
    hist = held.groupBy("stratum", "x.rule", "x.above").agg(
        F.sum("good").cast("long").alias("good"),
        F.sum(1 - F.col("good")).cast("long").alias("bad"))
    # a histogram row per stratum, rule and step: rejected at step s = all above >= s
    steps = cut(hist.groupBy("stratum", "rule").agg(
        F.collect_list(F.struct("above", "good", "bad")).alias("h"),
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad")), "quality-steps")
    m = max(1, steps.count() * grid)     # tests made in all strata together
    tested = (steps.select("stratum", "rule", "n_good", "n_bad", "h",
                           F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("step"))
              .withColumn("k", F.expr("aggregate(h, 0L, (a, x) -> a + IF(x.above >= step, x.good, 0L))"))
              .withColumn("caught", F.expr("aggregate(h, 0L, (a, x) -> a + IF(x.above >= step, x.bad, 0L))"))
              .drop("h"))
    low = F.create_map(*[F.lit(x) for r, (a, _) in RULES.items() for x in (r, a)])
    width = F.create_map(*[F.lit(x) for r, (a, b) in RULES.items() for x in (r, (b - a) / grid)])
    certified = tested.where(
        (binomial_tail(F.col("k"), F.col("n_good"), alpha / len(RULES)) <= delta / m)
        & (F.col("caught") * F.col("n_good") > 2 * F.col("k") * F.col("n_bad")))
    chosen = certified.groupBy("stratum", "rule").agg(F.min("step").alias("step")).withColumn(
        "cutoff", low[F.col("rule")] + F.col("step") * width[F.col("rule")])
    return chosen.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", **limits) -> DataFrame:
    """One row per document: counts, base_failed, the cutoffs in force and kept."""
    measured = cut(measures(docs, id_col, text_col, stratum_col), "quality-measures")
    cuts = cut(thresholds(measured, labels, id_col=id_col, **limits), "quality-cutoffs")
    over = F.lit(False)
    for r, v in scores().items():
        over = over | F.coalesce(v > F.col(f"max_{r}"), F.lit(False))
    return (measured.join(cuts.withColumnRenamed("stratum", "s"),
                          F.col("stratum").eqNullSafe(F.col("s")), "left").drop("s")
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~over)
            .withColumnRenamed("id", id_col))


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """Contract query: counts and verdict of every document."""
    out = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")
