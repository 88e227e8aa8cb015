"""Named queries over the driver tables, one per operator of the blueprint.

Every query reads the given parquet tables (through the catalogue plan of
``skulink.sources.fixture``) and returns a DataFrame of scalars or
joined strings; doubles are rounded to 6 places for comparison.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skulink.functions import text as tx
from skulink.functions import vectors as vx
from skulink.operators.candidates import JoinConfig, SetScorer, left_sets, right_sets
from skulink.operators.consolidate import (consolidate_by_left, consolidate_by_pair,
                                           consolidate_matches)
from skulink.operators import batched as bt
from skulink.operators import sentences as sn
from skulink.operators.embed import embed_texts
from skulink.operators.lookup import exclude_rows, first_by_key
from skulink.operators.pooling import pool_groups
from skulink.plans import cascade as cz
from skulink.plans.exclusion import CONTENT, match_excluding
from skulink.sources import fixture as fx
from skulink.sources import pages as pg
from skulink.sources import resume as rs
from skulink.session import cut, materialize

FLOOR_K = 41          # minimum slice: accept a best match at 0.41 or more
SENTINEL_K = 50       # the single round shown by sentinel_left_outer
PAIR_FLOOR_K = 30     # jaccard_pairs lists pairs scoring 0.30 or more
RESUME_K = 50         # resume_skip: an earlier run finished rounds >= 0.50
FIXTURE_RULE = pg.ListingRule(tag="div", css_class="ad")


def r6(c):
    return F.round(c, 6)


def _lr(spark, sf):
    return fx.fixture_sides(spark, sf)


def _names(spark, sf):
    return tuple(x.select("vendor", "pos", "product_name") for x in _lr(spark, sf))


def _scorer(left, right, cfg=JoinConfig()):
    # standardised catalogues feed several branches: write them once, each reader takes its own columns
    L = cut(left.withColumn("words", tx.name_words("product_name")), "left")
    R = cut(right.withColumn("words", tx.name_words("product_name")), "right")
    return L, R, SetScorer(left_sets(L), right_sets(R), cfg)


def _keyed(df):
    return df.withColumn("lkey", tx.set_key("words"))


# -- text (X1..X8) ----------------------------------------------------------
def q_clean_name(spark: SparkSession, sf: str) -> DataFrame:
    cat = fx.fixture_catalogue(spark, sf)
    return cat.select("pos", tx.clean_name("product_name").alias("clean_name"))


def q_word_set(spark, sf):
    cat = fx.fixture_catalogue(spark, sf)
    w = tx.name_words("product_name")
    return cat.select("pos", tx.set_key(w).alias("word_set"), F.size(w).alias("n_words"))


def q_colors(spark, sf):
    cat = fx.fixture_catalogue(spark, sf)
    return cat.select("pos", F.array_join(tx.color_set("product_name"), ",").alias("colors"))


def q_measures(spark, sf):
    cat = fx.fixture_catalogue(spark, sf)
    return cat.select("pos", F.array_join(tx.measure_set("product_name"), ",").alias("measures"))


# -- scoring join (J1, A1, F1, P1) --------------------------------------------
def q_jaccard_pairs(spark, sf):
    L, R, sc = _scorer(*_names(spark, sf))
    pairs = sc.pairs_at_least(PAIR_FLOOR_K)
    lrows = _keyed(L).select(F.col("pos").alias("left_pos"), "lkey")
    rrows = R.select("vendor", F.col("pos").alias("right_pos"), tx.set_key("words").alias("rkey"))
    return (pairs.join(lrows, "lkey").join(rrows, ["vendor", "rkey"])
            .select("left_pos", "right_pos", "inter", "uni",
                    r6(F.col("inter") / F.col("uni")).alias("score")))


def _best_rows(spark, sf):
    L, R, sc = _scorer(*_lr(spark, sf))
    last = F.broadcast(R.groupBy("vendor").agg(F.max("pos").alias("last_pos")))
    rows = (cz.per_vendor(_keyed(L), ["Alpha"]).join(sc.best(), ["vendor", "lkey"], "left")
            .join(last, "vendor"))
    return rows.select("*", F.coalesce("best_pos", "last_pos").alias("match_pos"),
                       F.coalesce(F.col("inter") / F.col("uni"), F.lit(0.0)).alias("score"),
                       F.coalesce("inter", F.lit(0)).alias("i"), F.coalesce("uni", F.lit(1)).alias("u")), R


def q_best_match_floor(spark, sf):
    rows, R = _best_rows(spark, sf)
    acc = rows.where(F.lit(100) * F.col("i") >= F.lit(FLOOR_K) * F.col("u"))
    out = cz.attach_rows(acc.withColumn("match_k", F.lit(FLOOR_K)), R)
    return cz.prefixed(out.withColumn("score", r6("score")), "Base", "Alpha")


def q_agreement_label(spark, sf):
    rows, R = _best_rows(spark, sf)
    out = cz.attach_rows(rows.withColumn("match_k", F.lit(0)), R)
    return out.select("left_pos", F.col("match_pos").alias("right_pos"), "agreement")


def q_sentinel_left_outer(spark, sf):
    rows, R = _best_rows(spark, sf)
    ok = F.lit(100) * F.col("i") >= F.lit(SENTINEL_K) * F.col("u")
    acc = rows.withColumn("match_k", F.when(ok, F.lit(SENTINEL_K)))
    acc = acc.withColumn("match_pos", F.when(ok, F.col("match_pos")))
    out = cz.attach_rows(acc, R)
    rnd = cz.round_output(out, cz.Grid(start=SENTINEL_K / 100)).where(F.col("k") == SENTINEL_K)
    return rnd.select("left_pos", "right_product_id", "right_product_name", r6("score").alias("score"))


# -- band candidates (F2, F3, A2, A3) ----------------------------------------
def _band_sets(spark, sf):
    L, R, sc = _scorer(*_names(spark, sf))
    band = sc.band(cz.Grid().band_ks)
    return _keyed(L).select(F.col("pos").alias("left_pos"), "lkey").join(band, "lkey"), R, sc, L


def q_exact_score_band(spark, sf):
    L, R, sc = _scorer(*_names(spark, sf))
    pairs = sc.pairs_in(cz.Grid().band_ks)
    lrows = _keyed(L).select(F.col("pos").alias("left_pos"), "lkey")
    rrows = R.select("vendor", F.col("pos").alias("right_pos"), tx.set_key("words").alias("rkey"))
    return (pairs.join(lrows, "lkey").join(rrows, ["vendor", "rkey"])
            .select("left_pos", "right_pos", F.col("k").cast("int").alias("k")))


def q_first_in_band(spark, sf):
    b, *_ = _band_sets(spark, sf)
    return b.select("left_pos", F.col("k").cast("int").alias("k"), F.col("first_pos").alias("right_pos"))


def q_last_in_band(spark, sf):
    b, *_ = _band_sets(spark, sf)
    return b.select("left_pos", F.col("k").cast("int").alias("k"), F.col("last_pos").alias("right_pos"))


# -- text for the encoder, pooling, vectors (X9..X16, A9) -------------------------
def q_stopword_filter(spark, sf):
    docs = fx.table(spark, sf, "documents")
    toks = tx.remove_stop_words(tx.tokenize("text"))
    return docs.select("doc_id", F.array_join(toks, " ").alias("filtered"),
                       F.size(toks).alias("n_tokens"))


def _label_tokens(spark, sf):
    return fx.table(spark, sf, "embeddings").select("vec_id", "label", "embedding")


def _pool_grouped(spark, sf, strategy):
    """A9 over a grouped table: a label's rows in vec_id order are its token vectors."""
    pooled = pool_groups(_label_tokens(spark, sf), "label", "vec_id", "embedding", strategy)
    return (pooled.select("label", F.posexplode("pooled").alias("dim", "value"))
            .select("label", "dim", r6("value").alias("value")))


def q_pool_mean(spark, sf):
    return _pool_grouped(spark, sf, "mean")


def q_pool_max(spark, sf):
    return _pool_grouped(spark, sf, "max")


def q_pool_cls(spark, sf):
    return _pool_grouped(spark, sf, "cls")


def q_l2_normalize(spark, sf):
    e = _label_tokens(spark, sf)
    return (e.select("vec_id", F.posexplode(vx.l2_normalize("embedding")).alias("dim", "value"))
            .select("vec_id", "dim", r6("value").alias("value")))


def q_cosine_pairs(spark, sf):
    e = _label_tokens(spark, sf)
    a = e.select(F.col("vec_id").alias("vec_id"), F.col("embedding").alias("a"))
    b = e.select(F.col("vec_id").alias("next_id"), F.col("embedding").alias("b"))
    return (a.join(b, b.next_id == a.vec_id + 1)
            .select("vec_id", "next_id", r6(vx.cosine("a", "b")).alias("cosine")))


def q_semantic_pair_score(spark, sf):
    L = cz.prepare_left(fx.fixture_left(spark, sf))
    R = fx.fixture_right(spark, sf)
    pairs = (L.select(F.col("pos").alias("left_pos"), F.col("product_name").alias("l_name"),
                      F.col("desc_by_id").alias("l_desc"))
             .join(R.select(F.col("pos").alias("right_pos"), F.col("product_name").alias("r_name"),
                            F.col("product_desc").alias("r_desc")),
                   F.col("right_pos") == F.col("left_pos") + 1))
    s = cz._pair_cosines(pairs, None, "mean", None)
    return s.select("left_pos", "right_pos", r6("title_sim").alias("title_sim"),
                    r6("desc_sim").alias("desc_sim"), r6("sim").alias("score"))


def q_desc_lookup(spark, sf):
    L = cz.prepare_left(fx.fixture_left(spark, sf))
    return L.select("pos", "product_id", F.coalesce("desc_by_id", F.lit("")).alias("desc_by_id"))


# -- bands and cascades (I2..I7) ------------------------------------------------
def _band_only(m):
    return (m.where(F.col("match_k").between(30, 40))
            .select(F.col("pos").alias("left_pos"), "match_k", "match_pos", r6("score").alias("score")))


def q_direct_band(spark, sf):
    L, R = _lr(spark, sf)
    return _band_only(cz.match_none(L, R, band="direct"))


def q_assisted_band(spark, sf):
    L, R = _lr(spark, sf)
    return _band_only(cz.match_none(L, R, band="assisted", hits=fx.fixture_hits(spark, sf),
                                    hit_key="product_id"))


def q_nohit_fallback(spark, sf):
    L, R = _lr(spark, sf)
    hits = fx.fixture_hits(spark, sf)
    m = cz.match_none(L, R, band="assisted", hits=hits, hit_key="product_id")
    nohit = m.join(hits.select(F.col("query_key").alias("product_id")).distinct(),
                   "product_id", "left_anti")
    return _band_only(nohit)


def q_hit_lookup(spark, sf):
    R = fx.fixture_right(spark, sf)
    h = cz.hit_rows(fx.fixture_hits(spark, sf), R)
    first = first_by_key(R, ["vendor", "product_id"], "pos", "pos")
    return (h.join(first, ["vendor", "product_id"])
            .select("query_key", "rank", "product_id", F.col("pos").alias("right_pos"),
                    F.col("product_name").alias("right_name")))


def _label(k):
    return F.when(F.col(k).isNotNull(), tx.threshold_label(F.col(k)))


def _cascade_view(m):
    return m.select(F.col("pos").alias("left_pos"), "match_pos", "match_k",
                    _label("match_k").alias("threshold"), r6("score").alias("score"))


def q_cascade_none(spark, sf):
    L, R = _lr(spark, sf)
    return _cascade_view(cz.match_none(L, R, band="off"))


def q_cascade_none_banded(spark, sf):
    L, R = _lr(spark, sf)
    return _cascade_view(cz.match_none(L, R, band="direct"))


def q_cascade_matched(spark, sf):
    L, R = _lr(spark, sf)
    return _cascade_view(match_excluding(L, R, "matched", band="direct"))


def q_cascade_last_scanned(spark, sf):
    L, R = _lr(spark, sf)
    return _cascade_view(match_excluding(L, R, "last_scanned", band="direct"))


def q_assisted_excluding(spark, sf):
    L, R = _lr(spark, sf)
    return _cascade_view(match_excluding(L, R, "matched", band="assisted", hits=fx.fixture_hits(spark, sf),
                                         hit_key="product_id"))


def q_multi_vendor_excluding(spark, sf):
    L, R = fx.fixture_sides(spark, sf, n_vendors=6)
    m = match_excluding(L, R, "matched", band="direct")
    return m.select("vendor", F.col("pos").alias("left_pos"), "match_pos", "match_k",
                    _label("match_k").alias("threshold"), r6("score").alias("score"))


def _banded_rows(spark, sf):
    L, R = _lr(spark, sf)
    return cz.attach_rows(cz.match_none(L, R, band="direct"), R)


def q_round_output(spark, sf):
    rnd = cz.round_output(_banded_rows(spark, sf))
    return rnd.select("left_pos", "threshold", "right_product_id", "right_product_name",
                      r6("score").alias("score"))


def q_consolidate_by_left(spark, sf):
    c = consolidate_matches(_banded_rows(spark, sf), cz.Grid().ks[-1])
    return c.select("left_product_id", "left_product_name", "threshold", "right_product_id",
                    "right_product_name", r6("score").alias("score"))


def q_consolidate_by_pair(spark, sf):
    c = consolidate_by_pair(_banded_rows(spark, sf))
    return c.select("left_product_id", "right_product_id", "left_pos", "match_k",
                    r6("score").alias("score"))


def q_right_exclusion(spark, sf):
    rows, R = _best_rows(spark, sf)
    acc = rows.where(F.lit(100) * F.col("i") >= F.lit(FLOOR_K) * F.col("u"))
    recorded = R.join(acc.select("vendor", F.col("match_pos").alias("pos")), ["vendor", "pos"])
    content = ["vendor"] + CONTENT
    return exclude_rows(R, recorded, content).select("pos", "product_id")


def q_resume_skip(spark, sf):
    """A resumed run of two vendors: only Alpha's rounds >= 0.50 are done."""
    L, R = fx.fixture_sides(spark, sf, n_vendors=2)
    scorer = cz.cascade_scorer(L, R)       # word scores are the same in both runs
    first = cz.attach_rows(cz.match_none(L, R, band="direct", scorer=scorer), R)
    earlier = first.where((F.col("match_k") >= RESUME_K) & (F.col("vendor") == "Alpha"))
    log = materialize(rs.log_entries(earlier).unionByName(
        spark.range(RESUME_K, 81).select(F.lit("Alpha").alias("vendor"), F.lit("threshold").alias("kind"),
                                          tx.threshold_label(F.col("id")).alias("key"))))
    m = cz.attach_rows(cz.match_none(L, R, band="direct", done=log, scorer=scorer), R)
    rnd = cz.round_output(m).join(rs.done_thresholds(log), ["vendor", "threshold"], "left_anti")
    return rnd.select("vendor", "left_pos", "threshold", "right_product_id", r6("score").alias("score"))


def q_multi_vendor(spark, sf):
    L, R = fx.fixture_sides(spark, sf, n_vendors=6)
    m = cz.match_none(L, R, band="direct")
    return m.select("vendor", F.col("pos").alias("left_pos"), "match_pos", "match_k",
                    r6("score").alias("score"))


# -- pages (S9, J8) -------------------------------------------------------------
def q_listing_ids(spark, sf):
    p = fx.table(spark, sf, "pages")
    ids = pg.extract_listing_ids(p, FIXTURE_RULE).select(
        "page_id", F.lit("id").alias("kind"), "rank", F.col("product_id").alias("value"))
    links = pg.extract_links(p).select("page_id", F.lit("href").alias("kind"), "rank",
                                       F.col("href").alias("value"))
    return ids.unionByName(links)


def q_listing_two_hop(spark, sf):
    return pg.two_hop_ids(fx.table(spark, sf, "pages"), FIXTURE_RULE)


# -- files (S1, S4, S6, S7) -------------------------------------------------------
def q_csv_roundtrip(spark, sf):
    from skulink.session import scratch_path
    from skulink.sources import catalogue as ct
    R = fx.fixture_right(spark, sf)
    path = scratch_path(spark, "catalogue")
    ct.write_catalogue(R, path, "Alpha")
    # descriptions are whole documents: cells with line breaks
    back = ct.read_catalogue(spark, path, "Alpha", "Alpha", multi_line=True)
    return back.select("pos", "product_id", "product_name", "product_desc")


def q_csv_many_files(spark, sf):
    """Row ordinals over several split files whose cells hold line breaks."""
    from skulink.session import scratch_path
    from skulink.sources import catalogue as ct
    R = fx.fixture_right(spark, sf)
    path = scratch_path(spark, "catalogue")
    rows = R.repartitionByRange(4, "pos").sortWithinPartitions("pos").select(
        *[F.col(c).alias(f"Alpha_{c}") for c in ct.CATALOGUE_FIELDS])
    ct.csv_options(rows.write).option("quoteAll", True).csv(path)
    back = ct.read_catalogue(spark, path, "Alpha", "Alpha", pos_column=None)
    return back.select("pos", "product_id", "product_name", "product_desc")


def q_round_files_merge(spark, sf):
    from skulink.session import scratch_path
    from skulink.sources import catalogue as ct
    rnd = cz.round_output(_banded_rows(spark, sf))
    path = scratch_path(spark, "rounds")
    ct.write_rounds(rnd, path, "Base")
    back = ct.read_rounds(spark, path, "Base", multi_line=True)
    c = consolidate_by_left(back.drop("source_file"))
    return c.select("left_product_id", "threshold", "right_product_id", r6("score").alias("score"))


def _two_vendor_rows(spark, sf):
    L, R = fx.fixture_sides(spark, sf, n_vendors=2)
    return cz.attach_rows(cz.match_none(L, R, band="direct"), R)


def q_final_sink(spark, sf):
    """Written per vendor and read back."""
    from skulink.session import scratch_path
    from skulink.sources import catalogue as ct
    path = scratch_path(spark, "final")
    ct.write_final(_two_vendor_rows(spark, sf), path, "Base")
    back = spark.read.parquet(path)
    return back.select(F.col("vendor").cast("string").alias("vendor"),
                       F.col("Base_product_id").alias("left_product_id"),
                       F.col("Vendor_product_id").alias("right_product_id"),
                       r6("Vendor_Match_Score").alias("score"))


def q_round_file_count(spark, sf):
    """Round tables of two vendors, counted from the files."""
    from skulink.session import scratch_path
    from skulink.sources import catalogue as ct
    path = scratch_path(spark, "rounds")
    ct.write_rounds(cz.round_output(_two_vendor_rows(spark, sf)), path, "Base", fmt="parquet")
    return ct.count_files(ct.read_rounds(spark, path, "Base", fmt="parquet"))


# -- text helpers and the encoder contract (X12, X17, E1) ---------------------------
def q_score_text(spark, sf):
    cat = fx.fixture_catalogue(spark, sf)
    return cat.select("pos", tx.parse_score_text("product_price").alias("value"))


def q_truncated_tokens(spark, sf):
    toks = tx.tokenize("text")
    return fx.table(spark, sf, "documents").select(
        "doc_id", F.array_join(tx.truncate_tokens(toks), " ").alias("kept"),
        F.size(toks).alias("n_tokens"))


def letter_encoder():
    """A caller's own encoder: one vector of letter counts per token (Arrow batches)."""
    @F.pandas_udf("array<array<double>>")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series([[[float(w.count(c)) for c in "aeiost"] for w in t.split(" ")] if t else []
                          for t in texts])
    return encode


def q_encoder_udf(spark, sf):
    """Product names through a pandas UDF encoder, each distinct text once."""
    cat = fx.fixture_catalogue(spark, sf).select("pos", "product_name")
    vec = embed_texts(cat, "product_name", encoder=letter_encoder())
    return (vec.select("pos", F.posexplode("vec").alias("dim", "value"))
            .select("pos", "dim", r6("value").alias("value")))


VOCABULARY_WORDS = 5_000     # whole words of the example vocabulary, the most frequent


def corpus_vocabulary(docs: DataFrame, n_words: int = VOCABULARY_WORDS) -> bt.Subwords:
    """An example vocabulary: frequent words, their one to three first letters and last letters.

    At most seven pieces a word reach the driver, ids follow the pieces' order.
    """
    words = docs.select(F.explode(tx.remove_stop_words(tx.tokenize("text"))).alias("w"))
    top = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(n_words).select("w")
    parts = [F.col("w")]
    for k in (1, 2, 3):
        parts += [F.substring("w", 1, k), F.concat(F.lit("##"), F.substring("w", -k, k))]
    pieces = top.select(F.explode(F.array(*parts)).alias("p")).distinct()
    names = ["[PAD]", "[UNK]", "[CLS]", "[SEP]"] + sorted(r["p"] for r in pieces.collect())
    return bt.Subwords({p: i for i, p in enumerate(names)})


def toy_model():
    """Six numbers per piece, each moved by the mean over all places that are not padding."""
    def run(ids, mask):
        own = np.stack([ids * (2 * j + 3) % 101 / 101.0 - 0.5 for j in range(6)], axis=2)
        mean = (own * mask[:, :, None]).sum(axis=1) / mask.sum(axis=1)[:, None]
        return own + 0.5 * mean[:, None, :]
    return run


def q_subword_limit(spark, sf):
    """The sub-words that a model's limit of 128 places keeps, and how many the text has."""
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    sub = bt.subwords(tx.remove_stop_words(tx.tokenize("text")), corpus_vocabulary(docs))
    return docs.select("doc_id", sub.alias("s")).select(
        "doc_id", F.array_join(F.col("s.ids").cast("array<string>"), " ").alias("ids"),
        F.col("s.n_subwords").alias("n_subwords"))


def q_batched_encoder(spark, sf):
    """Whole documents through a batched encoder, largest value over the places kept."""
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    encoder = bt.BatchEncoder(toy_model, corpus_vocabulary(docs))
    vec = embed_texts(docs, "text", encoder=encoder, pooling="max")
    return (vec.select("doc_id", F.posexplode("vec").alias("dim", "value"))
            .select("doc_id", "dim", r6("value").alias("value")))


def q_assisted_by_name(spark, sf):
    """I7 with the product's name as the search text."""
    L, R = _lr(spark, sf)
    return _band_only(cz.match_none(L, R, band="assisted", hit_key="product_name",
                                    hits=fx.fixture_hits(spark, sf, by="product_name")))


# -- sentences (X9) ----------------------------------------------------------------
def q_pointed_types(spark, sf):
    """How far each type seen with a final point is an abbreviation, over all documents."""
    return sn.pointed_types(fx.table(spark, sf, "documents")).select(
        "type", "n_pointed", "n_plain", r6("score").alias("score"),
        (F.col("score") >= sn.THRESHOLD).alias("abbreviation"))


def q_sentence_tokens(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    return sn.tokenize_sentences(docs, "doc_id").select(
        "doc_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n_tokens"))


# -- listing rules (F5, X18, X19, P6) ----------------------------------------------
def q_listing_rules(spark, sf):
    """The rules' options: text an element must hold, a delimiter, nesting and parentheses."""
    p = fx.table(spark, sf, "pages")
    rules = {"contains": pg.ListingRule("li", contains='"/th'),
             "delimiter": pg.ListingRule("title", delimiter=" "),
             "nested": pg.ListingRule("li", strip_parens=True,
                                      within=pg.ListingRule("ul", within=pg.ListingRule("nav")))}
    out = None
    for name, rule in rules.items():
        part = pg.extract_listing_ids(p, rule).select(
            "page_id", F.lit(name).alias("rule"), "rank", F.col("product_id").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def q_listing_unclosed(spark, sf):
    """Elements whose end tags the pages leave out: paragraphs, and bold text by itself and inside them."""
    p = fx.table(spark, sf, "pages")
    rules = {"p": pg.ListingRule("p"), "b": pg.ListingRule("b"),
             "b in p": pg.ListingRule("b", within=pg.ListingRule("p"))}
    parts = [pg.extract_listing_ids(p, rule).select(
        "page_id", F.lit(name).alias("rule"), "rank", F.col("product_id").alias("value"))
        for name, rule in rules.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_listing_by_url(spark, sf):
    """J8 + P6: links completed by a base URL meet the detail pages' own URL."""
    p = fx.table(spark, sf, "pages")
    h1 = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    shop = p.withColumn("url", F.concat(F.lit("https://shop.example/"), F.split(h1, " ", 2)[0]))
    return pg.two_hop_ids(shop, FIXTURE_RULE, base_url="https://shop.example", key="url")


QUERIES = {
    "clean_name": q_clean_name,
    "word_set": q_word_set,
    "jaccard_pairs": q_jaccard_pairs,
    "best_match_floor": q_best_match_floor,
    "colors": q_colors,
    "measures": q_measures,
    "agreement_label": q_agreement_label,
    "sentinel_left_outer": q_sentinel_left_outer,
    "desc_lookup": q_desc_lookup,
    "exact_score_band": q_exact_score_band,
    "first_in_band": q_first_in_band,
    "last_in_band": q_last_in_band,
    "stopword_filter": q_stopword_filter,
    "pool_mean": q_pool_mean,
    "pool_max": q_pool_max,
    "pool_cls": q_pool_cls,
    "l2_normalize": q_l2_normalize,
    "cosine_pairs": q_cosine_pairs,
    "semantic_pair_score": q_semantic_pair_score,
    "direct_band": q_direct_band,
    "hit_lookup": q_hit_lookup,
    "nohit_fallback": q_nohit_fallback,
    "assisted_band": q_assisted_band,
    "cascade_none": q_cascade_none,
    "cascade_none_banded": q_cascade_none_banded,
    "cascade_matched": q_cascade_matched,
    "cascade_last_scanned": q_cascade_last_scanned,
    "assisted_excluding": q_assisted_excluding,
    "multi_vendor_excluding": q_multi_vendor_excluding,
    "round_output": q_round_output,
    "consolidate_by_left": q_consolidate_by_left,
    "consolidate_by_pair": q_consolidate_by_pair,
    "right_exclusion": q_right_exclusion,
    "resume_skip": q_resume_skip,
    "listing_ids": q_listing_ids,
    "listing_two_hop": q_listing_two_hop,
    "multi_vendor": q_multi_vendor,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_many_files": q_csv_many_files,
    "round_files_merge": q_round_files_merge,
    "final_sink": q_final_sink,
    "round_file_count": q_round_file_count,
    "score_text": q_score_text,
    "truncated_tokens": q_truncated_tokens,
    "encoder_udf": q_encoder_udf,
    "assisted_by_name": q_assisted_by_name,
    "listing_rules": q_listing_rules,
    "listing_by_url": q_listing_by_url,
    "listing_unclosed": q_listing_unclosed,
    "pointed_types": q_pointed_types,
    "sentence_tokens": q_sentence_tokens,
    "subword_limit": q_subword_limit,
    "batched_encoder": q_batched_encoder,
}
