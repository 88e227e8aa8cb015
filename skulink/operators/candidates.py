"""Scoring join between a base catalogue and vendor catalogues.

Never a cross join.  Both sides collapse to distinct word sets (A4); a right
set keeps its lowest and highest row ordinal, which is all the tie rules need.
Every set's words are ranked once, rarest first (by the number of right sets
holding them, ties by text), and written with the set.

* Words held by more than ``hot_limit`` right sets are *hot*; they stand last in a set's
  order.  A pair's **rarest common word** decides where the pair is found.
* **It is not hot** (:func:`word_pairs`): a set of size n that is to reach score t indexes
  only its rarest ``n - ceil(t*n) + 1`` words (prefix filter); sizes alone and the position
  of the shared word bound the score before two sets are compared.  A pair is kept at
  its first common word, and a word meets ``hot_limit`` right sets at most.  Words whose pair
  count is still large are spread over a grid of join tasks, a slice of left sets
  against a slice of right sets.
* **All common words are hot** (:func:`subset_pairs`): a pair of sizes nl and nr that reaches t
  shares at least ``ceil(t/(1+t) * (nl+nr))`` words, so it holds the same subset of that many hot words.
  Sets meet by subset and size; what the join brings together is a pair asked for, so no list
  of sets sharing one frequent word is ever paired.
* **Best pair** (:meth:`SetScorer.best`): no list of hot pairs is needed.  For a left set
  and a set S of its hot words let ``m(S)`` be the size of the smallest right
  set holding all of S.  The best of ``|S| / (n + m(S) - |S|)`` over all S is
  the best score reachable through hot words: each term is
  reached by a real right set, and the true best pair's own common words give its
  score.  So right sets are reduced to one row per subset of hot words, and left
  sets meet them by an equi-join on the subset.  The other words are joined from ``first_k``
  up, and for sets that reached no such score again with the bounds found so far.

A set with more than ``max_subset_words`` hot words keeps the most frequent of
them for subsets; the others are joined word by word.

Scores are compared as integers: ``inter/uni >= k/100`` iff
``100*inter >= k*uni``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skulink.functions.text import set_key
from skulink.operators.skew import shuffled
from skulink.session import cut


def _empty_str_array():
    return F.array().cast("array<string>")


@dataclass(frozen=True)
class JoinConfig:
    hot_limit: int = 300          # right sets that hold a word before it is hot
    salt_limit: int = 100_000     # pairs one word may emit per join task before it is split
    max_grid: int = 128           # a word is split into at most max_grid ** 2 join tasks
    max_subset_words: int = 10    # hot words of a set whose subsets are enumerated
    first_k: int = 41             # best match: score (hundredths) of the first stage
    max_vendors: int = 10_000


def _key_words(key: str):
    # the set key is the sorted words joined by a space, so it gives them back
    return F.when(F.col(key) == "", _empty_str_array()).otherwise(F.split(key, " "))


def left_sets(left: DataFrame, words: str = "words") -> DataFrame:
    """Distinct left word sets: ``lkey, lwords, nl`` (a hash aggregate on the key)."""
    return (left.select(set_key(words).alias("lkey")).distinct()
            .withColumn("lwords", _key_words("lkey"))
            .withColumn("nl", F.size("lwords")))


def right_sets(right: DataFrame, words: str = "words") -> DataFrame:
    """Distinct right word sets per vendor with their row ordinals."""
    return (right.groupBy("vendor", set_key(words).alias("rkey"))
            .agg(F.min("pos").alias("min_pos"), F.max("pos").alias("max_pos"),
                 F.count(F.lit(1)).alias("n_rows"))
            .withColumn("rwords", _key_words("rkey"))
            .withColumn("nr", F.size("rwords")))


# Best-pair keys packed into one number each, so the per-left-set maximum
# runs as a hash aggregate (a struct maximum falls back to a sort-based one).
# A score inter/uni becomes the fixed point floor(inter * S / uni) with S
# above the square of the largest union, so different fractions stay
# different and in order.  The widths follow the data: short names fit a
# long, anything longer (up to 2^26 words, 2^42 rows) a 38-digit decimal.
POS_BITS = 42
MAX_POS = (1 << POS_BITS) - 1


@dataclass(frozen=True)
class Keys:
    """Number type and factors of the packed keys."""
    dtype: str = "decimal(38,0)"
    words: int = 1 << 26          # above the largest union
    rows: int = 1 << 42           # above the largest ordinal

    @classmethod
    def fit(cls, max_union: int, max_pos: int) -> "Keys":
        words, rows = 1 << int(max_union + 1).bit_length(), 1 << int(max_pos + 1).bit_length()
        # (score, ordinal) and (score, inter, uni) have to stay positive longs
        if 2 * words * words * max(rows, words * words) < 1 << 62:
            return cls("long", words, rows)
        return cls()

    def _lit(self, x: int):
        return F.lit(x).cast(self.dtype)

    def _quotient(self, a, b):
        return F.call_function("div", a, b) if self.dtype == "long" else F.floor(a / b).cast(self.dtype)

    def _fp(self, inter, uni):
        scale = self._lit(2 * self.words * self.words)
        return self._quotient((inter.cast(self.dtype) * scale).cast(self.dtype), uni.cast(self.dtype))

    def pos_key(self, inter, uni, pos):
        """Orders pairs by score, then by right ordinal."""
        return (self._fp(inter, uni) * self._lit(self.rows) + pos.cast(self.dtype)).cast(self.dtype)

    def frac_key(self, inter, uni):
        """Orders pairs by score and carries one (inter, uni) of that score."""
        w = self._lit(self.words)
        high = (self._fp(inter, uni) * w + inter.cast(self.dtype)).cast(self.dtype)
        return (high * w + uni.cast(self.dtype)).cast(self.dtype)

    def decode(self, pkey, fkey):
        """best_pos, inter, uni back out of the two packed keys."""
        w = self._lit(self.words)
        return ((pkey % self._lit(self.rows)).cast("long").alias("best_pos"),
                (self._quotient((fkey - fkey % w).cast(self.dtype), w) % w).cast("long").alias("inter"),
                (fkey % w).cast("long").alias("uni"))


def ranked_sets(lsets: DataFrame, rsets: DataFrame, cfg: JoinConfig = JoinConfig()):
    """Both sides with their words ranked rarest first: (left, right), written once.

    Adds ``toks`` (words by right frequency, then text), ``ids`` (their numbers: joins on single words
    move and compare those, not texts), ``sig`` (a bit for every word, by its number: see :func:`most_shared`),
    ``grid`` (per word, the side length of its task grid) and ``n_hot`` (hot words, the last ones of ``toks``).
    """
    lx = lsets.select("lkey", F.explode("lwords").alias("t"))
    rx = rsets.select("vendor", "rkey", F.explode("rwords").alias("t"))
    # one aggregation counts a word on both sides
    df = (lx.select("t", F.lit(1).alias("l"), F.lit(0).alias("r"))
          .unionByName(rx.select("t", F.lit(0).alias("l"), F.lit(1).alias("r")))
          .groupBy("t").agg(F.sum("l").alias("dl"), F.sum("r").alias("dr")))
    side = F.ceil(F.sqrt(F.col("dl") * F.col("dr") / F.lit(float(cfg.salt_limit))))
    df = cut(df.select("t", F.col("dr").alias("d"), F.least(
        F.greatest(side, F.lit(1)), F.lit(cfg.max_grid)).cast("int").alias("g"),
        F.monotonically_increasing_id().alias("id")), "word-counts")

    def ranked(sets, exploded, keys):
        words = (shuffled(exploded).join(df, "t").groupBy(*keys)
                 .agg(F.sort_array(F.collect_list(F.struct("d", "t", "g", "id"))).alias("w")))
        out = shuffled(sets).join(words, keys, "left").withColumns({
            "toks": F.coalesce("w.t", _empty_str_array()),
            "ids": F.coalesce("w.id", F.array().cast("array<long>")),
            "grid": F.coalesce("w.g", F.array().cast("array<int>")),
            "n_hot": F.coalesce(F.size(F.filter("w.d", lambda d: d > cfg.hot_limit)), F.lit(0))}).withColumn(
            "sig", F.aggregate("ids", F.lit(0).cast("long"), lambda bits, i: bits.bitwiseOR(F.call_function(
                "shiftleft", F.lit(1).cast("long"), i.bitwiseAND(F.lit(63)).cast("int")))))
        return cut(out.drop("w", "lwords", "rwords"), "ranked-sets")

    return ranked(lsets, lx, ["lkey"]), ranked(rsets, rx, ["vendor", "rkey"])


def prefix_length(n: Column, k, scale: int = 100) -> Column:
    """Rarest words of a set of size n of which one must be shared to reach k/scale."""
    need = F.floor((k * n + (scale - 1)) / F.lit(scale)).cast("int")
    return n - F.greatest(need, F.lit(1)) + 1


def postings(sets: DataFrame, key: str, size: str, upto: Column, other: str, start: Column | None = None,
             salted: bool = True) -> DataFrame:
    """One row per word at ranks ``start`` (0) to ``upto`` of a set and per slice of the other side.

    ``token`` is the word's number, ``at`` is the word's rank in the set, ``s_<key>`` the set's own slice and
    ``s_<other>`` the slice of the other side that it is to meet.
    """
    start = F.lit(0) if start is None else start
    n = F.greatest(upto - start, F.lit(0))
    zipped = F.arrays_zip(F.slice("ids", start + 1, n).alias("t"), F.slice("grid", start + 1, n).alias("g"))
    out = sets.where((F.col(size) > 0) & (n > 0)).withColumn("_from", start)
    out = out.select("*", F.posexplode(zipped).alias("_i", "w"))
    g = F.col("w.g") if salted else F.lit(1)
    return out.select(*[c for c in sets.columns if c not in ("toks", "grid")], (F.col("_from") + F.col("_i")).alias("at"),
                      F.col("w.t").alias("token"),
                      F.pmod(F.xxhash64(key), g).cast("int").alias(f"s_{key}"),
                      F.explode(F.sequence(F.lit(0), g - 1)).alias(f"s_{other}"))


def most_shared(n: Column, sig: Column, other: Column) -> Column:
    """Words that a set of ``n`` words with bits ``sig`` can share with a set of bits ``other``, at most.

    Every bit that the other set lacks stands for at least one word that it lacks.
    """
    return n - F.bit_count(sig.bitwiseAND(F.bitwise_not(other)))


def shared_words(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``pairs`` with ``both``, the words of two arrays in left order, compared once a pair.

    Tests on a plain column would be moved into the join, with the comparison written out at every use.
    """
    return pairs.withColumn("both", F.explode(F.array(F.array_intersect(left, right))))


def meet(lp: DataFrame, rp: DataFrame, reaches) -> DataFrame:
    """Left and right postings joined on the word; pairs verified and kept at their first common word.

    ``reaches(inter, uni)`` tests a score; it is first asked with the most that sizes, ranks and
    the words' bits leave possible, so few candidates have their words compared.  With a vendor
    on the left side only that vendor's right sets are met.
    """
    keys = ["token", "s_lkey", "s_rkey"] + (["vendor"] if "vendor" in lp.columns else [])
    rp = rp.withColumnsRenamed({"ids": "rids", "at": "rat", "sig": "rsig"}).drop("n_hot")
    j = shuffled(lp.drop("n_hot")).join(rp, keys)
    sizes = F.col("nl") + F.col("nr")
    most = F.least(F.col("nl") - F.col("at"), F.col("nr") - F.col("rat"))
    bits = F.least(most_shared(F.col("nl"), F.col("sig"), F.col("rsig")),
                   most_shared(F.col("nr"), F.col("rsig"), F.col("sig")))
    # one condition, cheapest test first, and no lambda in it: with one the join would run it uncompiled
    j = shared_words(j.where(reaches(most, sizes - most) & reaches(bits, sizes - bits)), "ids", "rids")
    # the common words in left order: their number, and whether this word is the first
    inter = F.size("both")
    j = j.where(reaches(inter, sizes - inter) & (F.get("both", F.lit(0)) == F.col("token")))
    return j.withColumns({"inter": inter, "uni": sizes - inter}).drop(
        "both", "ids", "rids", "sig", "rsig", "at", "rat", *keys[:3])


def at_least(k, scale: int = 100):
    """Test ``inter/uni >= k/scale`` in integers."""
    return lambda inter, uni: F.lit(scale) * inter >= k * uni


PAIR = ["vendor", "lkey", "rkey", "inter", "uni", "nl", "nr", "min_pos", "max_pos"]


@dataclass(frozen=True)
class Bounds:
    """What the written sets tell about a join: largest sizes, hot words shared, long lists of them."""
    max_nl: int = 0
    max_nr: int = 0
    n_hot: int = 0                # hot words a pair may share
    many_hot: bool = False        # some set has more hot words than subsets take

    @classmethod
    def of(cls, left: DataFrame, right: DataFrame, cfg: JoinConfig) -> "Bounds":
        n, hl = left.agg(F.max("nl"), F.max("n_hot")).first()
        m, hr = right.agg(F.max("nr"), F.max("n_hot")).first()
        return cls(n or 0, m or 0, min(hl or 0, hr or 0), max(hl or 0, hr or 0) > cfg.max_subset_words)


def subset_words(cfg: JoinConfig) -> Column:
    """The hottest hot words of a set, in rank order."""
    n = F.least("n_hot", F.lit(cfg.max_subset_words))
    return F.slice("toks", F.size("toks") - n + 1, n)


def word_pairs(rows: DataFrame, right: DataFrame, first: Column, reaches, cfg: JoinConfig, many_hot: bool,
               rfirst: Column | None = None) -> DataFrame:
    """Pairs whose rarest common word is not a subset word of both, by joins on single words.

    ``first`` (and ``rfirst``): the rarest words of a set among which that word must be.  Words that are
    not hot meet through their postings, at most ``hot_limit`` right sets each.  A hot word that a long
    list leaves out of the subsets meets all sets holding it; only such lists have any.
    """
    size, n_hot = F.size("toks"), F.col("n_hot")
    rfirst = size if rfirst is None else rfirst
    kept = size - F.least("n_hot", F.lit(cfg.max_subset_words))       # ranks from here on are subset words
    lp = postings(rows, "lkey", "nl", F.least(first, size - n_hot), "rkey")
    rp = postings(right, "rkey", "nr", F.least(rfirst, size - n_hot), "lkey")
    out = meet(lp, rp, reaches)
    if many_hot:
        # one side of these joins is short, so the words' task grids do not apply
        lp = postings(rows, "lkey", "nl", F.least(first, kept), "rkey", size - n_hot, salted=False)
        rp = postings(right, "rkey", "nr", rfirst, "lkey", size - n_hot, salted=False)
        out = out.unionByName(meet(lp, rp, reaches))
        lp = postings(rows, "lkey", "nl", first, "rkey", kept, salted=False)
        rp = postings(right, "rkey", "nr", F.least(rfirst, kept), "lkey", size - n_hot, salted=False)
        out = out.unionByName(meet(lp, rp, reaches))
    return out.select(*PAIR)


def least_common(min_k: int, scale: int, bounds: Bounds, cfg: JoinConfig) -> dict[int, int]:
    """Sum of two sets' sizes -> common words from which on they score ``min_k/scale`` (one at least)."""
    out = {}
    for t in range(2, bounds.max_nl + bounds.max_nr + 1):
        need = max(1, -(-min_k * t // (scale + min_k)))
        if need > min(cfg.max_subset_words, bounds.n_hot):
            break
        out[t] = need
    return out


def exact_common(ks: list[int], scale: int, bounds: Bounds, cfg: JoinConfig) -> dict[int, int]:
    """Sum of two sets' sizes -> the least common words that give a score of ``ks`` exactly."""
    out: dict[int, int] = {}
    for need in range(1, min(cfg.max_subset_words, bounds.n_hot) + 1):
        for k in ks:
            if k > 0 and need * (scale + k) % k == 0:
                out.setdefault(need * (scale + k) // k, need)
    return {t: n for t, n in out.items() if t <= bounds.max_nl + bounds.max_nr}


def subset_pairs(rows: DataFrame, right: DataFrame, common: dict[int, int], cfg: JoinConfig) -> DataFrame:
    """Pairs that share subset words only, at least ``common[nl + nr]`` of them.

    Such a pair holds the same subset of that many words.  Right sets become one row per subset,
    left sets one per subset and size of a right set for which a subset of that size is
    enough, so whatever the join brings together is a pair asked for, kept at its first common words.
    """
    need = sorted(set(common.values()))
    sums = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(n).alias("h")) for t, n in sorted(common.items())])

    def listed(sets, toks, *cols):
        x = F.explode(F.filter(subsets_of(subset_words(cfg)), lambda x: x["h"].isin(*need)))
        return sets.where(F.col("n_hot") >= need[0]).select("*", x.alias("x")).select(
            *cols, F.col("toks").alias(toks), "x.s", "x.h")

    vendor = ["vendor"] if "vendor" in rows.columns else []
    lp = listed(rows, "toks", *vendor, "nl")
    lp = lp.select("*", F.explode(F.transform(
        F.filter(sums, lambda x: (x["h"] == F.col("h")) & (x["t"] >= F.col("nl") + F.col("h"))),
        lambda x: x["t"] - F.col("nl"))).alias("nr"))
    rp = listed(right, "rtoks", "vendor", "nr", "min_pos", "max_pos").drop("h")
    j = shared_words(shuffled(lp).join(rp, [*vendor, "s", "nr"]), "toks", "rtoks")
    first = F.array_join(F.slice("both", F.lit(1), F.col("h")), " ")
    j = j.where(first == F.col("s")).withColumn("inter", F.size("both"))
    key = lambda c: F.array_join(F.array_sort(c), " ")
    return j.select(
        "vendor", key("toks").alias("lkey"), key("rtoks").alias("rkey"), "inter",
        (F.col("nl") + F.col("nr") - F.col("inter")).alias("uni"), "nl", "nr", "min_pos", "max_pos")


def _pairs(left: DataFrame, right: DataFrame, min_k: int, scale: int, common, cfg: JoinConfig,
           bounds: Bounds) -> DataFrame:
    out = word_pairs(left, right, prefix_length(F.col("nl"), min_k, scale), at_least(min_k, scale), cfg,
                     bounds.many_hot, prefix_length(F.col("nr"), min_k, scale))
    return out.unionByName(subset_pairs(left, right, common, cfg)) if common else out


def prefix_join(left: DataFrame, right: DataFrame, min_k: int, scale: int = 100,
                cfg: JoinConfig = JoinConfig(), bounds: Bounds | None = None) -> DataFrame:
    """All ranked pairs scoring ``min_k/scale`` or more (any shared word for 0)."""
    bounds = bounds or Bounds.of(left, right, cfg)
    return _pairs(left, right, min_k, scale, least_common(min_k, scale, bounds, cfg), cfg, bounds)


def exact_join(left: DataFrame, right: DataFrame, ks: list[int], scale: int = 100,
               cfg: JoinConfig = JoinConfig(), bounds: Bounds | None = None) -> DataFrame:
    """All ranked pairs scoring a value of ``ks`` exactly, with the score as ``k``."""
    bounds = bounds or Bounds.of(left, right, cfg)
    pairs = _pairs(left, right, max(min(ks, default=1), 1), scale, exact_common(ks, scale, bounds, cfg), cfg, bounds)
    k = _exact_k(F.col("inter"), F.col("uni"), scale, list(ks))
    return pairs.withColumn("k", k).where(F.col("k").isNotNull())


def subsets_of(words: Column) -> Column:
    """Every non-empty subset of an array, joined by spaces (words hold none)."""
    bit = lambda m, i: F.call_function("shiftright", m, i).bitwiseAND(F.lit(1)) == 1
    masks = F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.size(words)) - 1)
    return F.when(F.size(words) > 0, F.transform(masks, lambda m: F.struct(
        F.array_join(F.filter(words, lambda _, i: bit(m, i)), " ").alias("s"),
        F.bit_count(m).cast("int").alias("h"))))


class SetScorer:
    """The scoring job of one left side against one right side.

    ``settled_k``: the caller has no use for band rows of left sets whose best score
    reaches it, so the band join leaves them out.
    """

    def __init__(self, lsets: DataFrame, rsets: DataFrame, cfg: JoinConfig = JoinConfig(),
                 band_ks: list[int] | None = None, settled_k: int | None = None, ranked=None,
                 like: "SetScorer | None" = None):
        self.cfg, self.band_ks, self.settled_k = cfg, list(band_ks or []), settled_k
        self.left, self.right = ranked or ranked_sets(lsets, rsets, cfg)
        self._best: DataFrame | None = None
        self._bands: dict[tuple, DataFrame] = {}
        if like is not None:     # the same job with fewer rows: its bounds still hold
            self.vendors, self.keys, self.bounds = like.vendors, like.keys, like.bounds
            return
        r = self.right.agg(F.max("max_pos"), F.approx_count_distinct("vendor")).first()
        if (r[1] or 0) > cfg.max_vendors:
            raise ValueError(f"about {r[1]} vendors exceed the limit of {cfg.max_vendors}")
        self.vendors = sorted(v[0] for v in self.right.select("vendor").distinct().collect())
        self.bounds = Bounds.of(self.left, self.right, cfg)
        # packed keys are as wide as the longest names and the ordinals ask for
        self.keys = Keys.fit(self.bounds.max_nl + self.bounds.max_nr, r[0] or 0)

    @property
    def n_hot(self) -> int:
        return self.bounds.n_hot

    def _best_of(self, pairs: DataFrame) -> DataFrame:
        pk = self.keys.pos_key(F.col("inter"), F.col("uni"), F.col("max_pos"))
        fk = self.keys.frac_key(F.col("inter"), F.col("uni"))
        return pairs.groupBy("vendor", "lkey").agg(F.max(pk).alias("pk"), F.max(fk).alias("fk"))

    def hot_best(self, rows: DataFrame) -> DataFrame:
        """(vendor, lkey, pk, fk): best score through hot words, by subset."""
        key = F.array_join(subset_words(self.cfg), " ")
        hot = self.right.where(F.col("n_hot") > 0)
        # smallest size first, then the highest ordinal, in one long
        packed = F.shiftleft(F.col("nr").cast("long"), POS_BITS).bitwiseOR(
            F.lit(MAX_POS) - F.col("max_pos").cast("long"))
        groups = hot.groupBy("vendor", key.alias("u")).agg(F.min(packed).alias("m"))
        right = (groups.select("vendor", "m", F.explode(subsets_of(_key_words("u"))).alias("x"))
                 .groupBy("vendor", F.col("x.s").alias("s")).agg(F.min("m").alias("m")))
        lefts = rows.where(F.col("n_hot") > 0).select("vendor", "lkey", "nl", key.alias("u"))
        # a left set's subsets are the same for all vendors
        asked = (lefts.select("u", "nl").distinct()
                 .select("u", "nl", F.explode(subsets_of(_key_words("u"))).alias("x"))
                 .select("u", "nl", F.col("x.s").alias("s"), F.col("x.h").alias("h")))
        got = shuffled(asked).join(right, "s")
        uni = F.col("nl") + F.shiftright("m", POS_BITS).cast("int") - F.col("h")
        pos = F.lit(MAX_POS) - F.col("m").bitwiseAND(F.lit(MAX_POS))
        best = got.groupBy("vendor", "u", "nl").agg(
            F.max(self.keys.pos_key(F.col("h"), uni, pos)).alias("pk"),
            F.max(self.keys.frac_key(F.col("h"), uni)).alias("fk"))
        return shuffled(lefts).join(best, ["vendor", "u", "nl"]).select("vendor", "lkey", "pk", "fk")

    def rest_pairs(self, rows: DataFrame) -> DataFrame:
        """Pairs with a common word that is not a subset word, scoring the row's bound or more.

        ``rows`` carries the bound as ``inter0/uni0``.
        """
        n, i0, u0 = F.col("nl"), F.col("inter0"), F.col("uni0")
        need = F.floor((i0 * n + u0 - 1) / u0).cast("int")
        first = n - F.greatest(need, F.lit(1)) + 1
        return word_pairs(rows, self.right, first, lambda inter, uni: inter * u0 >= i0 * uni, self.cfg,
                          self.bounds.many_hot).select(*PAIR)

    def rescored(self, rows: DataFrame) -> DataFrame:
        """Best pairs of some (vendor, left set) rows alone: vendor, lkey, inter, uni, best_pos."""
        return self._unpacked(self._any_score(rows, staged=False))

    def _any_score(self, rows: DataFrame, staged: bool = True) -> DataFrame:
        """(vendor, lkey, pk, fk) of ``rows`` over pairs of any score.

        Few rows take one join of words with the bounds of the hot ones: not ``staged``.
        """
        k = max(self.settled_k or self.cfg.first_k, 1)
        parts = []
        if staged:
            high = word_pairs(rows, self.right, prefix_length(F.col("nl"), k), at_least(k), self.cfg,
                              self.bounds.many_hot, prefix_length(F.col("nr"), k))
            parts.append(cut(self._best_of(high), "best"))
        if self.n_hot:
            parts.append(cut(self.hot_best(rows), "hot-best"))
        if not parts:
            return self._best_of(self.rest_pairs(rows.withColumns({"inter0": F.lit(0), "uni0": F.lit(1)})))
        found = reduce(DataFrame.unionByName, parts)
        _, inter, uni = self.keys.decode(F.col("pk"), F.col("fk"))
        seen = found.groupBy("vendor", "lkey").agg(F.max("pk").alias("pk"), F.max("fk").alias("fk"))
        bound = seen.select("vendor", "lkey", inter.alias("inter0"), uni.alias("uni0"))
        rest = shuffled(rows).join(bound, ["vendor", "lkey"], "left").fillna({"inter0": 0, "uni0": 1})
        if staged:       # pairs of score k and more are all seen: only rows below it look at the other words
            rest = rest.where(100 * F.col("inter0") < k * F.col("uni0"))
        return found.unionByName(self._best_of(self.rest_pairs(rest)))

    def _unpacked(self, best: DataFrame) -> DataFrame:
        out = best.groupBy("vendor", "lkey").agg(F.max("pk").alias("pk"), F.max("fk").alias("fk"))
        pos, inter, uni = self.keys.decode(F.col("pk"), F.col("fk"))
        return out.select("vendor", "lkey", inter, uni, pos)

    # -- results -----------------------------------------------------------
    def best(self) -> DataFrame:
        """A1 per (vendor, lkey): highest score, then highest right ordinal.

        Columns ``vendor, lkey, inter, uni, best_pos``; ``inter/uni`` equals
        the best score (as a fraction it may come from another pair of the
        same score, e.g. 3/9 for 2/6).  Left sets sharing no word with any
        right set are absent (their best score is 0).
        """
        if self._best is None:
            rows = self.left.withColumn("vendor", F.explode(F.array(*[F.lit(v) for v in self.vendors])))
            self._best = cut(self._unpacked(self._any_score(rows)), "best")
        return self._best

    def band(self, band_ks: list[int], scale: int = 100, keep: bool = False) -> DataFrame:
        """F2 + A2 + A3 per (vendor, lkey, k) for the band grid values.

        ``first_pos`` = lowest ordinal and ``last_pos`` = highest ordinal of
        a right row whose score is exactly ``k/scale``.  ``keep``: written for further callers.
        """
        asked = (*band_ks, scale)
        if keep and asked not in self._bands:
            self._bands[asked] = cut(self.band(band_ks, scale), "band")
        if asked in self._bands:
            return self._bands[asked]
        rows = self.left
        if band_ks and scale == 100 and self.settled_k and set(band_ks) <= set(self.band_ks):
            # a best score below the band or from settled_k on leaves nothing to ask for
            inter, uni = 100 * F.col("inter"), F.col("uni")
            rows = shuffled(rows).join(self.best().where((inter >= min(band_ks) * uni) & (inter < self.settled_k * uni))
                             .select("vendor", "lkey"), "lkey")
        return (exact_join(rows, self.right, list(band_ks), scale, self.cfg, self.bounds)
                .groupBy("vendor", "lkey", "k")
                .agg(F.min("min_pos").alias("first_pos"), F.max("max_pos").alias("last_pos")))

    def pairs_at_least(self, min_k: int, scale: int = 100) -> DataFrame:
        """Set pairs with ``inter/uni >= min_k/scale``: vendor, lkey, rkey, inter, uni."""
        return prefix_join(self.left, self.right, min_k, scale, self.cfg, self.bounds).select(
            "vendor", "lkey", "rkey", "inter", "uni")


    def pairs_in(self, ks: list[int], scale: int = 100) -> DataFrame:
        """Set pairs with ``inter/uni == k/scale`` for a ``k`` of ``ks``: vendor, lkey, rkey, inter, uni, k."""
        return exact_join(self.left, self.right, list(ks), scale, self.cfg, self.bounds).select(
            "vendor", "lkey", "rkey", "inter", "uni", "k")


def _exact_k(inter, uni, scale: int, ks: list[int]):
    """Grid value k in ``ks`` with ``inter/uni == k/scale`` exactly, else null."""
    num = F.lit(scale) * inter
    k = F.when((uni > 0) & (num % uni == 0), (num / uni).cast("int"))
    return F.when(k.isin(*ks), k) if ks else F.lit(None).cast("int")
