"""I1..I7: the descending-threshold matching cascade as Spark plans.

The sequential job lowers a threshold over a grid (0.80 .. 0.00 by 0.01);
in each round every still-unmatched left row takes its best right row and
keeps it when the score reaches the threshold.  Inside the band
(0.30 .. 0.40) a round only looks at right rows whose word score equals
the threshold exactly and scores them with embeddings instead.

Without right-row exclusion (policy ``none``) a left row's fate depends on
the right catalogue only, so the whole cascade has a closed form computed
in one pass: the best pair gives the first plain round that accepts, the
band candidates give the band rounds that accept, and the highest
accepted round wins.  Rounds are integers ``k`` (hundredths).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skulink.functions.text import (NO_MATCH_NAME, agreement, color_set, measure_set,
                                    name_words, null_to_empty, threshold_label)
from skulink.functions.vectors import cosine
from skulink.operators.candidates import JoinConfig, SetScorer, left_sets, right_sets
from skulink.operators.embed import Encoder, sentence_vector
from skulink.operators.lookup import first_by_key
from skulink.operators.skew import bounded_broadcast, shuffled
from skulink.session import cut
from skulink.sources.resume import skip_done_left

SCALE = 100
FIELDS = ["product_category", "product_sub_category", "product_id", "product_name",
          "product_quantity", "product_price", "product_url", "image_url"]


@dataclass(frozen=True)
class Grid:
    """Threshold grid and semantic band, in hundredths."""
    start: float = 0.80
    step: float = 0.01
    band_lo: float = 0.30
    band_hi: float = 0.40
    stop: float = 0.00      # last round (Q5: stop before 0.00 to leave weak rows unmatched)

    def __post_init__(self):
        s, st = self.start * SCALE, self.step * SCALE
        if self.step <= 0:
            raise ValueError("threshold step must be positive")
        if abs(st - round(st)) > 1e-9 or abs(s - round(s)) > 1e-9:
            raise ValueError("start and step must be multiples of 0.01")

    @property
    def ks(self) -> list[int]:
        start, step = round(self.start * SCALE), round(self.step * SCALE)
        return list(range(start, round(self.stop * SCALE) - 1, -step))

    @property
    def band_ks(self) -> list[int]:
        lo, hi = round(self.band_lo * SCALE), round(self.band_hi * SCALE)
        return [k for k in self.ks if lo <= k <= hi]

    @property
    def plain_ks(self) -> list[int]:
        band = set(self.band_ks)
        return [k for k in self.ks if k not in band]


def prepare_left(left: DataFrame, fold_case: bool = False) -> DataFrame:
    """Left rows with word set, set key and the description by id."""
    # written before the self join, so the catalogue and its words are computed once
    left = cut(left.drop("words", "desc_by_id").withColumn("words", name_words("product_name", fold_case)),
               "left-words")
    # an id that one row holds gives that row its own description, so only shared ids move theirs
    shared, n = bounded_broadcast(left.where(F.col("product_id").isNotNull()).groupBy("product_id").count()
                                  .where(F.col("count") > 1).select("product_id"))
    own = F.when(F.col("product_id").isNotNull(), F.col("product_desc"))
    if n == 0:
        return left.withColumn("desc_by_id", own)
    rows = left.join(shared, "product_id", "left_semi")
    desc = first_by_key(rows, "product_id", "pos", "product_desc").withColumnRenamed(
        "product_desc", "desc_by_id")
    return cut(left.join(shared, "product_id", "left_anti").withColumn("desc_by_id", own)
               .unionByName(rows.join(desc, "product_id", "left")), "left")


def prepare_right(right: DataFrame, fold_case: bool = False) -> DataFrame:
    return right.drop("words").withColumn("words", name_words("product_name", fold_case))


def vendors_of(right: DataFrame, max_vendors: int = 10_000) -> list[str]:
    """Distinct vendor labels (a bounded list: checked before it is used)."""
    vs = right.select("vendor").distinct()
    n = vs.count()
    if n > max_vendors:
        raise ValueError(f"{n} vendors exceed the limit of {max_vendors}")
    return sorted(r[0] for r in vs.collect())


def per_vendor(left: DataFrame, vendors: list[str]) -> DataFrame:
    """Each left row once per vendor (output rows = left x vendors)."""
    return left.drop("vendor").withColumn(
        "vendor", F.explode(F.array(*[F.lit(v) for v in vendors])))


def _first_k(ks: list[int], inter, uni) -> F.Column:
    """Largest grid value in ``ks`` (descending) reached by ``inter/uni``."""
    arr = F.array(*[F.lit(k) for k in ks]) if ks else F.array().cast("array<int>")
    return F.try_element_at(F.filter(arr, lambda k: F.lit(SCALE) * inter >= k * uni), F.lit(1))


def cascade_scorer(left: DataFrame, right: DataFrame, grid: Grid = Grid(), band: str = "direct",
                   cfg: JoinConfig = JoinConfig(), fold_case: bool = False) -> SetScorer:
    """The scoring job of :func:`match_none`, for callers that run it more than once over the same catalogues."""
    band_ks = grid.band_ks if band != "off" else []
    above = [k for k in grid.plain_ks if k > max(band_ks)] if band_ks else []
    words = name_words("product_name", fold_case)
    return SetScorer(left_sets(left.withColumn("words", words)), right_sets(right.withColumn("words", words)),
                     cfg, band_ks=band_ks, settled_k=min(above) if above else None)


def match_none(left: DataFrame, right: DataFrame, grid: Grid = Grid(), band: str = "direct",
               hits: DataFrame | None = None, hit_key: str = "product_name",
               encoder: Encoder | None = None, pooling: str = "mean", stop_words=None,
               cfg: JoinConfig = JoinConfig(), fold_case: bool = False,
               scorer: SetScorer | None = None, done: DataFrame | None = None) -> DataFrame:
    """Closed-form cascade (policy ``none``), one row per (vendor, left row).

    ``done``: a resume log (vendor, kind, key); what it names is left out.  ``scorer``: a
    :func:`cascade_scorer` of the same catalogues and settings, shared by several runs.

    Columns: every left column, ``vendor``, ``match_pos`` (right ``pos``,
    null when the vendor has no rows), ``score``, ``match_k``.
    ``band``: ``off`` (plain rounds only), ``direct`` or ``assisted``.
    """
    if band not in ("off", "direct", "assisted"):
        raise ValueError(f"unknown band mode: {band}")
    if band == "assisted" and hits is None:
        raise ValueError("assisted band needs a hits table")
    band_ks = grid.band_ks if band != "off" else []
    plain_ks = [k for k in grid.ks if k not in set(band_ks)]
    # tables, so each reader takes its own columns and the texts are read where they are scored
    left = prepare_left(left, fold_case)
    # of the right side, the columns that scoring reads; without a band no text is moved or written
    texts = ["product_name", "product_desc"] if band_ks else []
    texts += ["product_id"] if band_ks and band == "assisted" else []
    right = cut(prepare_right(right, fold_case).select("vendor", "pos", "words", *texts), "right")
    vendors = vendors_of(right)
    shared = scorer is not None
    if not shared:
        above = [k for k in plain_ks if k > max(band_ks)] if band_ks else []
        scorer = SetScorer(left_sets(left), right_sets(right), cfg, band_ks=band_ks,
                           settled_k=min(above) if above else None)
    lv = per_vendor(left, vendors).withColumn("lkey", F.array_join(F.array_sort("words"), " "))
    if done is not None:
        lv = skip_done_left(lv, done)
    last = F.broadcast(right.groupBy("vendor").agg(F.max("pos").alias("last_pos")))
    rows = (shuffled(lv).join(scorer.best(), ["vendor", "lkey"], "left")
              .join(last, "vendor", "left"))
    inter = F.coalesce("inter", F.lit(0)).cast("long")
    uni = F.coalesce("uni", F.lit(1)).cast("long")
    rows = (rows.withColumn("plain_pos", F.coalesce("best_pos", "last_pos"))
                .withColumn("plain_score", F.when(F.col("uni").isNotNull(), inter / uni)
                            .otherwise(F.lit(0.0)))
                .withColumn("plain_k", F.when(F.col("last_pos").isNotNull(),
                                              _first_k(plain_ks, inter, uni))))
    if band_ks:
        below = F.col("plain_k").isNull() | (F.col("plain_k") < min(band_ks))
        eligible = rows.where(below & F.col("last_pos").isNotNull())
        cands = shuffled(eligible.select("vendor", "pos", "lkey", "product_name", "desc_by_id",
                                         F.col(hit_key).alias("_qkey"))).join(
            scorer.band(band_ks, keep=shared), ["vendor", "lkey"])
        if band == "direct":
            acc = _direct_band(cands, right, encoder, pooling, stop_words)
        else:
            acc = _assisted_band(cands, right, hits, encoder, pooling, stop_words)
        # at most one accepted row per band round and left row, so the list
        # is bounded (<= 11): a hash-based object aggregate, not a sort
        best_band = acc.groupBy("vendor", "pos").agg(
            F.array_max(F.collect_list(F.struct("k", "b_pos", "b_score"))).alias("bb"))
        rows = shuffled(rows).join(best_band, ["vendor", "pos"], "left")
        use_band = F.col("bb").isNotNull() & (F.col("plain_k").isNull()
                                              | (F.col("bb.k") > F.col("plain_k")))
        rows = (rows.withColumn("match_k", F.when(use_band, F.col("bb.k")).otherwise(F.col("plain_k")))
                    .withColumn("match_pos", F.when(use_band, F.col("bb.b_pos")).otherwise(F.col("plain_pos")))
                    .withColumn("score", F.when(use_band, F.col("bb.b_score")).otherwise(F.col("plain_score"))))
    else:
        rows = (rows.withColumn("match_k", F.col("plain_k"))
                    .withColumn("match_pos", F.col("plain_pos"))
                    .withColumn("score", F.col("plain_score")))
    rows = rows.withColumn("match_pos", F.when(F.col("match_k").isNotNull(), F.col("match_pos")))
    rows = rows.withColumn("score", F.when(F.col("match_k").isNotNull(), F.col("score")))
    keep = [c for c in left.columns if c not in ("vendor",)]
    return rows.select(*keep, "vendor", "lkey", "match_pos", "score", "match_k")


def _pair_cosines(pairs: DataFrame, encoder, pooling, stop_words) -> DataFrame:
    """X15 + X16: mean of title and description cosine for each pair row.

    ``pairs`` holds ``l_name, l_desc, r_name, r_desc``.  Texts are told apart
    by their SHA-256; every distinct text is embedded once, the vectors are
    written, and pairs meet them by digest, so whole descriptions are shuffled
    once and never serve as join keys.  The empty text, which a third of all
    rows may share, is not joined at all: its vector is a constant.
    """
    texts = ("l_name", "l_desc", "r_name", "r_desc")
    tid = lambda c: F.when(null_to_empty(c) != "", F.sha2(F.col(c), 256))
    keyed = cut(pairs.select("*", *[tid(c).alias(f"id_{c}") for c in texts]), "pairs")
    seen = None
    for c in texts:
        part = keyed.where(F.col(f"id_{c}").isNotNull()).select(
            F.col(f"id_{c}").alias("id"), F.col(c).alias("text"))
        seen = part if seen is None else seen.unionByName(part)
    vec = cut(seen.groupBy("id").agg(F.first("text").alias("text"))
              .select("id", sentence_vector(F.col("text"), encoder, pooling, stop_words).alias("vec")),
              "vectors")
    empty = pairs.sparkSession.range(1).select(
        sentence_vector(F.lit(""), encoder, pooling, stop_words).alias("v")).first()["v"]
    blank = F.array(*[F.lit(float(x)) for x in empty or []]).cast(vec.schema["vec"].dataType)
    out = keyed
    for c in texts:
        v = vec.select(F.col("id").alias(f"id_{c}"), F.col("vec").alias(f"v_{c}"))
        out = shuffled(out).join(v, f"id_{c}", "left").withColumn(f"v_{c}", F.coalesce(f"v_{c}", blank))
    return (out.withColumn("title_sim", cosine("v_l_name", "v_r_name"))
               .withColumn("desc_sim", cosine("v_l_desc", "v_r_desc"))
               .withColumn("sim", (F.col("title_sim") + F.col("desc_sim")) / 2)
               .drop(*[f"v_{c}" for c in texts], *[f"id_{c}" for c in texts]))


def row_vectors(rows: DataFrame, keys: list[str], encoder, pooling, stop_words) -> DataFrame:
    """``keys`` with ``v_name`` and ``v_desc``: each distinct text of (name, desc) embedded once."""
    tid = lambda c: F.when(null_to_empty(c) != "", F.sha2(F.col(c), 256))
    keyed = cut(rows.select(*keys, "name", "desc", tid("name").alias("id_name"), tid("desc").alias("id_desc")),
                "texts")
    seen = keyed.select(F.col("id_name").alias("id"), F.col("name").alias("text")).unionByName(
        keyed.select(F.col("id_desc").alias("id"), F.col("desc").alias("text"))).where(F.col("id").isNotNull())
    vec = cut(seen.groupBy("id").agg(F.first("text").alias("text"))
              .select("id", sentence_vector(F.col("text"), encoder, pooling, stop_words).alias("vec")), "vectors")
    empty = rows.sparkSession.range(1).select(
        sentence_vector(F.lit(""), encoder, pooling, stop_words).alias("v")).first()["v"]
    blank = F.array(*[F.lit(float(x)) for x in empty or []]).cast(vec.schema["vec"].dataType)
    out = keyed.drop("name", "desc")
    for c in ("name", "desc"):
        v = vec.select(F.col("id").alias(f"id_{c}"), F.col("vec").alias(f"v_{c}"))
        out = shuffled(out).join(v, f"id_{c}", "left").withColumn(f"v_{c}", F.coalesce(f"v_{c}", blank))
    return cut(out.drop("id_name", "id_desc"), "row-vectors")


def _direct_band(cands: DataFrame, right: DataFrame, encoder, pooling, stop_words) -> DataFrame:
    """Score the first exact-score row of each band round; accept at >= k."""
    r = right.select("vendor", F.col("pos").alias("first_pos"),
                     F.col("product_name").alias("r_name"), F.col("product_desc").alias("r_desc"))
    pairs = (cands.select("vendor", "pos", "k", "first_pos",
                          F.col("product_name").alias("l_name"), F.col("desc_by_id").alias("l_desc"))
             .join(shuffled(r), ["vendor", "first_pos"]))
    scored = _pair_cosines(pairs, encoder, pooling, stop_words)
    return (scored.where(F.col("sim") >= F.col("k") / F.lit(float(SCALE)))
            .select("vendor", "pos", "k", F.col("first_pos").alias("b_pos"),
                    F.col("sim").alias("b_score")))


def hit_rows(hits: DataFrame, right: DataFrame) -> DataFrame:
    """Each hit id -> first right row (lowest ``pos``) with that id.

    The catalogue is cut to the ids that occur in the hits (a semi join)
    before the first-row aggregation, so its cost follows the hits.
    """
    wanted = right.join(hits.select("vendor", "product_id").distinct(),
                        ["vendor", "product_id"], "left_semi")
    first = first_by_key(wanted, ["vendor", "product_id"], "pos", ["product_name", "product_desc"])
    return hits.join(first, ["vendor", "product_id"])


def _assisted_band(cands: DataFrame, right: DataFrame, hits: DataFrame, encoder, pooling,
                   stop_words) -> DataFrame:
    """Band rounds scored through search hits.

    With hits, the score is the best mean cosine over the hits found in the
    catalogue and the match is the round's first exact-score row.  Without
    hits, the round's last exact-score row is taken at score ``k``.
    """
    sims = hit_sims(cands, right, hits, encoder, pooling, stop_words)
    return _assisted_accept(cands, hits, sims).select("vendor", "pos", "k", "b_pos", "b_score")


def hit_sims(rows: DataFrame, right: DataFrame, hits: DataFrame, encoder, pooling, stop_words) -> DataFrame:
    """(vendor, pos, hit_sim): best mean cosine of a left row over its hits in the catalogue."""
    lrows = rows.select("vendor", "pos", "_qkey", "product_name", "desc_by_id").distinct()
    found = hit_rows(hits, right).select("vendor", F.col("query_key").alias("_qkey"),
                                         F.col("product_name").alias("r_name"),
                                         F.col("product_desc").alias("r_desc"))
    pairs = (lrows.select("vendor", "pos", "_qkey", F.col("product_name").alias("l_name"),
                          F.col("desc_by_id").alias("l_desc"))
             .join(found, ["vendor", "_qkey"]))
    return (_pair_cosines(pairs, encoder, pooling, stop_words)
            .groupBy("vendor", "pos").agg(F.max("sim").alias("hit_sim")))


def _assisted_accept(cands: DataFrame, hits: DataFrame, sims: DataFrame) -> DataFrame:
    """Accepted rows of assisted band rounds: vendor, pos, k, b_pos, b_score, with_hits, last_pos."""
    has = hits.select("vendor", F.col("query_key").alias("_qkey")).distinct().withColumn(
        "has_hits", F.lit(True))
    c = (cands.join(has, ["vendor", "_qkey"], "left")
              .join(sims, ["vendor", "pos"], "left"))
    thr = F.col("k") / F.lit(float(SCALE))
    with_hits = F.col("has_hits").isNotNull()
    accept = F.when(with_hits, F.col("hit_sim").isNotNull() & (F.col("hit_sim") >= thr)) \
              .otherwise(F.lit(True))
    return (c.where(accept)
             .select("vendor", "pos", "k",
                     F.when(with_hits, F.col("first_pos")).otherwise(F.col("last_pos")).alias("b_pos"),
                     F.when(with_hits, F.col("hit_sim")).otherwise(thr).alias("b_score"),
                     with_hits.alias("with_hits"), "last_pos"))


# ---------------------------------------------------------------------------
# Output shaping

def attach_rows(result: DataFrame, right: DataFrame, measure_mode: str = "as_written") -> DataFrame:
    """Left fields, matched right fields, score, round, agreement label.

    ``measure_mode="value"`` compares whole numbers and lower-cased units (Q3).
    """
    r = right.select("vendor", F.col("pos").alias("match_pos"),
                     *[F.col(f).alias(f"right_{f}") for f in FIELDS])
    out = result.join(r, ["vendor", "match_pos"], "left")
    lab = agreement(color_set("product_name"), color_set("right_product_name"),
                    measure_set("product_name", measure_mode),
                    measure_set("right_product_name", measure_mode))
    return out.select(
        "vendor", F.col("pos").alias("left_pos"),
        *[F.col(f).alias(f"left_{f}") for f in FIELDS],
        *[F.col(f"right_{f}") for f in FIELDS],
        "match_pos", "score", "match_k",
        F.when(F.col("match_k").isNotNull(), threshold_label(F.col("match_k"))).alias("threshold"),
        F.when(F.col("match_k").isNotNull(), lab).alias("agreement"))


def round_output(matches: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """I5 + P2: one row per left row and round until (and including) its match.

    The match round carries the right fields; earlier rounds carry the
    sentinel (empty right fields, the no-match name, score 0).
    """
    ks = F.array(*[F.lit(k) for k in grid.ks])
    out = matches.withColumn("k", F.explode(F.filter(
        ks, lambda k: F.col("match_k").isNull() | (k >= F.col("match_k")))))
    hit = F.col("k") == F.coalesce(F.col("match_k"), F.lit(-1))
    cols = []
    for f in FIELDS:
        c = F.col(f"right_{f}")
        sentinel = F.lit(NO_MATCH_NAME) if f == "product_name" else F.lit("")
        cols.append(F.when(hit, c).otherwise(sentinel).alias(f"right_{f}"))
    return out.select(
        "vendor", "left_pos", *[F.col(f"left_{f}") for f in FIELDS], *cols,
        F.when(hit, F.col("score")).otherwise(F.lit(0.0)).alias("score"),
        F.col("k"), threshold_label(F.col("k")).alias("threshold"),
        F.when(hit, F.col("match_pos")).alias("match_pos"))


def prefixed(df: DataFrame, left_label: str, vendor_label: str) -> DataFrame:
    """The 17-column round/final layout with catalogue-label prefixes."""
    cols = [F.col(f"left_{f}").alias(f"{left_label}_{f}") for f in FIELDS]
    cols += [F.col(f"right_{f}").alias(f"{vendor_label}_{f}") for f in FIELDS]
    cols.append(F.col("score").alias(f"{vendor_label}_Match_Score"))
    return df.select(*cols)


def require_agreement(matches: DataFrame, level: str = "both") -> DataFrame:
    """Q2 option: keep accepted matches whose colours (and measures) agree.

    ``level="both"`` keeps only full agreement, ``"colors"`` also keeps a
    measure mismatch.  The cascade itself never uses the label, as written.
    """
    from skulink.functions.text import AGREE_BOTH, AGREE_COLORS_ONLY
    ok = [AGREE_BOTH] if level == "both" else [AGREE_BOTH, AGREE_COLORS_ONLY]
    if level not in ("both", "colors"):
        raise ValueError(f"unknown agreement level: {level}")
    return matches.where(F.col("agreement").isin(*ok))
