"""X9, sentence-aware: points that end a sentence are tokens, those of abbreviations are not.

Which types are abbreviations is learnt from the corpus itself, without a word
list: a type that nearly always carries a final point is one (log-likelihood
ratio of "the point belongs to the type" against "points fall as often here as
anywhere"), weighted so that short types, types with inner points and types
rarely seen without one count more (Kiss and Strunk, 2006).  Words are counted
by a partially aggregated ``groupBy``; only the sums over all words reach the
driver.

Word rules are those of :func:`skulink.functions.text.tokenize`, except that
points inside a word stay ("u.s", "v2.0") and so does an abbreviation's
("dr."); the last word of a text always gives up its point.

Defined results: null and blank texts have no words and no tokens; repeated
rows count each; an empty table has no types; ids may repeat or be null; the
private-use character U+E000 reads as a point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skulink.functions.text import _c, null_to_empty, split_tokens
from skulink.functions.vectors import let
from skulink.operators.skew import MAX_BROADCAST_ROWS, bounded_broadcast
from skulink.session import cut

THRESHOLD = 0.3                 # least score of an abbreviation
KEPT = "\ue000"                 # stands for a point that is part of a word
POINTED_RE = r"(?s)^(.*[\p{L}\p{N}])\.([^\p{L}\p{N}.]*)$"
INNER_RE = r"([\p{L}\p{N}_])\.([\p{L}\p{N}_])"
LEAD_RE, TRAIL_RE = r"^[^\p{L}\p{N}]+", r"[^\p{L}\p{N}]+$"
KEPT_TOKEN_RE = (r"``|''|\.\.\.|n't|'\p{L}+|\p{N}+(?:[," + KEPT + r"]\p{N}+)+" + KEPT + r"?"
                 r"|[\p{L}\p{N}_" + KEPT + r"]+(?:-[\p{L}\p{N}_" + KEPT + r"]+)*|[^\s\p{L}\p{N}_" + KEPT + "]")


def words(x) -> Column:
    """Lower-cased words between white space."""
    return F.filter(F.split(F.lower(null_to_empty(x)), r"\s+"), lambda w: w != "")


def pointed_type(w: Column) -> Column:
    """Type of a word with a final point, '' for other words."""
    return F.regexp_replace(F.regexp_extract(w, POINTED_RE, 1), LEAD_RE, "")


def plain_type(w: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(w, LEAD_RE, ""), TRAIL_RE, "")


def type_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``type, n_pointed, n_plain`` of every type with a letter, over all texts."""
    # words are counted and written first: a word's type is found once, not at each of its occurrences,
    # where the optimiser would else move the test for a letter
    w = cut(docs.select(F.explode(words(text_col)).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")),
            "words")
    w = w.select(pointed_type(F.col("w")).alias("pointed"), "w", "n")
    w = w.select((F.col("pointed") != "").alias("p"), "n",
                 F.when(F.col("pointed") != "", F.col("pointed")).otherwise(plain_type(F.col("w"))).alias("type"))
    return (w.where(F.col("type").rlike(r"\p{L}")).groupBy("type")
            .agg(F.sum(F.when(F.col("p"), F.col("n")).otherwise(0)).alias("n_pointed"),
                 F.sum(F.when(F.col("p"), F.lit(0)).otherwise(F.col("n"))).alias("n_plain")))


def pointed_types(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``type, n_pointed, n_plain, score`` of every type seen with a final point.

    A score is 0 where points are no more likely than elsewhere.
    """
    types = cut(type_counts(docs, text_col), "types")
    total, points = types.agg(F.sum(F.col("n_pointed") + F.col("n_plain")), F.sum("n_pointed")).first()
    p = min(max((points or 0) / (total or 1), 1e-12), 1 - 1e-12)
    log = lambda v: F.log(F.lit(v))
    ratio = 2 * (F.col("n_pointed") * (log(0.99) - log(p)) + F.col("n_plain") * (log(0.01) - log(1 - p)))
    size = F.char_length(F.replace("type", F.lit("."), F.lit("")))
    inner = F.char_length("type") - size
    weight = F.exp(-size) * (inner + 1) * F.pow(size.cast("double"), -F.col("n_plain"))
    return types.where("n_pointed > 0").select(
        "type", "n_pointed", "n_plain", F.greatest(ratio * weight, F.lit(0.0)).alias("score"))


def abbreviations(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``type`` of the corpus's abbreviations."""
    return pointed_types(docs, text_col).where(F.col("score") >= threshold).select("type")


def sentence_tokens(x, known) -> Column:
    """Tokens of a text; ``known``: array of the abbreviations that it holds."""
    def kept(ws: Column) -> Column:
        return F.transform(ws, lambda w, i: F.when(
            w.contains(".") & (i < F.size(ws) - 1) & F.array_contains(known, pointed_type(w)),
            F.regexp_replace(w, POINTED_RE, "$1" + KEPT + "$2")).otherwise(w))

    s = F.array_join(let(words(x), kept), " ")
    for _ in range(2):            # neighbouring points share a letter
        s = F.regexp_replace(s, INNER_RE, "$1" + KEPT + "$2")
    return F.transform(split_tokens(s, KEPT_TOKEN_RE), lambda t: F.translate(t, KEPT, "."))


def tokenize_sentences(docs: DataFrame, id_col: str, text_col: str = "text", out_col: str = "tokens",
                       known: DataFrame | None = None, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``docs`` with a column of tokens; ``known``: abbreviations, learnt from ``docs`` by default.

    A document meets the abbreviations once per distinct pointed type; only types found travel
    back to it, by id (rows with one id share them, which changes nothing).
    """
    known, _ = bounded_broadcast(abbreviations(docs, text_col) if known is None else known.select("type"),
                                 max_broadcast_rows)
    # only words with a point can have such a type; equal ones are looked at once
    dotted = F.array_distinct(F.filter(words(text_col), lambda w: w.contains(".")))
    pointed = F.array_distinct(F.filter(F.transform(dotted, pointed_type), lambda t: t != ""))
    has = (docs.select(F.col(id_col).alias("_id"), F.explode(pointed).alias("type")).join(known, "type")
           .groupBy("_id").agg(F.collect_set("type").alias("_known")))
    none = F.array().cast("array<string>")
    return (docs.join(has, _c(id_col).eqNullSafe(F.col("_id")), "left")
            .select(*[F.col(c) for c in docs.columns if c != out_col],
                    sentence_tokens(F.col(text_col), F.coalesce("_known", none)).alias(out_col)))
