"""N-gram Jaccard join with PartEnum signatures (operator 4).

A document is the set of its distinct word shingles.  Two sets of similarity
J >= t differ in at most (1 - t) / t * min size elements, so within a band
of sizes the join is a Hamming-distance join with a known bound k.  PartEnum
splits the feature domain by hash into n1 = ceil((k + 1) / 2) first-level
partitions; k differences leave one of them with at most one.  Each is split
into ``PARTS`` parts, and the signatures are the hashes of all subsets that
leave one part out: one difference falls into one part, so two similar sets
share the signature that leaves it out.  A set signs for its own band and,
where a smaller partner can lie in the band below, for that one; no
similar pair is missed.

From signatures to classes without listing pairs of a group:

1. rows collapse to distinct sets first (128-bit digest), so copies sign once
   per task and never meet each other again;
2. signature groups with two or more sets are kept; in each, every member is
   paired with the group's smallest member, its hub (a star: as many pairs as
   members).  A profile of each set (shingles per hash range, a byte each) bounds what
   two sets can share; only for pairs that it allows are the shingle sets made again,
   moved together and verified exactly;
3. verified links are contracted to components (large star / small star);
4. in groups that reach over several components, members outside their hub's may
   still link with each other or with other members.  A hub's members are dealt into
   chunks of ``CHUNK`` shingles, outsiders against all, and each pair of
   chunks is one bounded task: first on profiles, which leave the members that any
   profile of another component allows to link, then on the shingles of those,
   counting common ones through an inverted index and returning only links that
   join two components.

Every pair that shares a signature is thereby verified or already in one
component, so the classes are exact.  Families whose members are all linked
to each other or to the hub never get to step 4.

Shingles are 64-bit hashes of word hashes; two different shingles of one
compared pair collide with a chance below 1e-12 even for texts of a million
words.  Joins on hubs can be skewed; they are plain equi-joins of small rows
that adaptive execution splits.

Defined results: null, empty and word-less texts have an empty set, link with
nothing and stand for themselves; fewer words than a shingle make one
shingle of the whole sequence; repeated rows and repeated ids are rows of
their own with equal sets; a class's id is its smallest id (null ids are
larger than any; a class of null ids only has a null id); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skulink.llm.common import fresh, held
from skulink.session import cut, discard, reclaim

SHINGLE = 3          # words
PERCENT = 90         # Jaccard similarity, in percent
STAGE_SHINGLE, STAGE_PERCENT = 5, 80   # of the pipeline's near duplicates
PARTS = 3            # second-level parts; signatures leave one out
BAND = 1.25          # ratio of a size band's ends
CHUNK = 1_000_000    # shingles of the members that meet in one task, per side
WORDS_KEPT = 200_000  # word hashes a worker remembers
FILTER_BITS = 1 << 23  # of the filter that texts pass before they are moved (1 MB, whatever the input)

C1, C2, C3 = (np.uint64(c) for c in
              (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class WordHashes(dict):
    """64-bit hash per word; forgets everything when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer (a bijection of 64-bit integers)."""
    x = (x ^ (x >> np.uint64(30))) * C2
    x = (x ^ (x >> np.uint64(27))) * C3
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (UTF-8 bytes)."""
    words = raw.lower().split() if raw else []   # bytes: only A-Z and ASCII white space
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(held("word hashes", WordHashes).__getitem__, words), np.uint64, n)
    size = min(size, n)
    acc = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        acc = mix(acc * C1 + h[i:n - size + 1 + i])
    return np.unique(acc)


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def node_of(key: bytes) -> int:
    return int.from_bytes(key[:8], "big", signed=True)


def band_ends(largest: int, percent: int) -> list[int]:
    """Upper ends of the size bands up to the one that holds ``largest``.

    A band's end is at least 100 / percent times the end before, so partners
    lie in the same or in neighbouring bands.
    """
    ends = [1]
    while ends[-1] < largest:
        e = ends[-1]
        ends.append(max(e + 1, int(e * BAND), e * 100 // percent))
    return ends


def salted(band: int, c: np.uint64) -> np.uint64:
    return np.uint64((band + 1) * int(c) & 0xFFFFFFFFFFFFFFFF)


def signatures(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Signature hashes of a non-empty set."""
    n = len(s)
    ends = band_ends(n, percent)
    own = len(ends) - 1
    out = []
    for band in (own, own - 1):
        # the band below, only where a partner of sufficient size can be in it
        if band < 0 or (band < own and 100 * ends[band] < percent * n):
            continue
        k = ends[band] * (100 - percent) // percent
        n1 = (k + 2) // 2
        parts = PARTS if k else 1
        m = mix(s + salted(band, C1))
        part = ((m >> np.uint64(32)) * np.uint64(n1 * parts)) >> np.uint64(32)
        total = np.zeros(n1 * parts, np.uint64)
        np.add.at(total, part.astype(np.int64), mix(m))
        if parts > 1:
            by_first = total.reshape(n1, parts)
            total = (by_first.sum(axis=1, dtype=np.uint64)[:, None] - by_first).ravel()
        out.append(mix(total + mix(np.arange(len(total), dtype=np.uint64)
                                   + salted(band, C2))))
    return np.concatenate(out)


def described(docs: DataFrame, size: int) -> DataFrame:
    """uid, id, n_shingles, key and profile h (key null for empty sets) per row."""
    @F.pandas_udf("n long, key binary, h binary")
    def describe(texts: pd.Series) -> pd.DataFrame:
        out = []
        for raw in texts:
            s = shingles(raw, size)
            out.append((len(s), digest(s), profile(s)) if len(s) else (0, None, None))
        return pd.DataFrame(out, columns=["n", "key", "h"])

    return (docs.select("uid", "id", describe("raw").alias("d"))
            .select("uid", "id", F.col("d.n").alias("n_shingles"), F.col("d.key").alias("key"),
                    F.col("d.h").alias("h")))


def signed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(sig, node) rows; a task signs a set once however often it occurs there."""
    def sign(batches):
        seen: set[bytes] = set()
        for batch in batches:
            sigs, nodes, rows = [], [], 0
            for raw in batch.column(0):
                s = shingles(raw.as_py(), size)
                if not len(s):
                    continue
                key = digest(s)
                if key in seen:
                    continue
                seen.add(key)
                sg = signatures(s, percent)
                sigs.append(sg.view(np.int64))
                nodes.append(np.full(len(sg), node_of(key), np.int64))
                rows += len(sg)
                if rows > 200_000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in (sigs, nodes)], ["sig", "node"])
                    sigs, nodes, rows = [], [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (sigs, nodes)], ["sig", "node"])

    return docs.select("raw").mapInArrow(sign, "sig long, node long")


def profile(s: np.ndarray) -> bytes | None:
    """How many shingles fall into each of about n hash ranges, a byte each (null: more than 255)."""
    bits = max(len(s), 1).bit_length() - 1
    n = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(s), np.int64),
                    minlength=1 << bits)
    return n.astype(np.uint8).tobytes() if n.max() < 256 else None


def most_common(a: bytes | None, b: bytes | None, na: int, nb: int) -> int:
    """Upper bound of two sets' common shingles from their profiles."""
    if a is None or b is None:
        return min(na, nb)
    x, y = np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)
    while len(x) > len(y):
        x = x.reshape(-1, 2).sum(axis=1)
    while len(y) > len(x):
        y = y.reshape(-1, 2).sum(axis=1)
    return int(np.minimum(x, y).sum())


def profiled(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, key, uid, n, h) of the sets in ``nodes``: ``uid`` is one row that holds the set."""
    node = F.expr("conv(hex(substring(key, 1, 8)), 16, -10)").cast("long")
    return (rows.where(F.col("key").isNotNull()).groupBy("key")
            .agg(F.min("uid").alias("uid"), F.first("n_shingles").alias("n"), F.first("h").alias("h"))
            .withColumn("node", node).join(nodes, "node", "left_semi"))


def sifted(docs: DataFrame, wanted: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` whose ``uid`` may be one of ``wanted``: none of those is missing, few others stay.

    A bitmap of the hashed row numbers, of a fixed size, is sent to the rows; an exact join follows.
    """
    bit = F.pmod(F.xxhash64("uid"), F.lit(bits))
    marks = wanted.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("marks"))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("marks", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (docs.withColumns({"bucket": F.bitmap_bucket_number(bit), "at": at})
            .join(F.broadcast(marks), "bucket").where(byte.bitwiseAND(F.expr("shiftleft(1, cast(at % 8 as int))")) != 0)
            .select(*docs.columns))


def shingle_sets(docs: DataFrame, size: int, profiles: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, key, n, s) of the sets in ``nodes``: one text per set is read again.

    Only sets that must be compared exactly are asked for, and only texts whose row number
    may be among theirs are moved.
    """
    @F.pandas_udf("array<long>")
    def sets(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(raw, size).view(np.int64) for raw in texts])

    reps = cut(profiles.join(nodes, "node", "left_semi").select("uid", "node", "key"), "representatives")
    out = cut(sifted(docs.select("uid", "raw"), reps).join(reps, "uid").select("node", "key", sets("raw").alias("s"))
              .select("node", "key", "s", F.size("s").alias("n")), "shingles")
    discard(reps)
    return out


def promising(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs whose sizes and profiles allow the similarity; no shingles are moved."""
    @F.pandas_udf("long")
    def bound(a: pd.Series, b: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        return pd.Series([most_common(*x) for x in zip(a, b, na, nb)])

    side = lambda x: sets.select(F.col("node").alias(x), F.col("h").alias(f"h{x}"),
                                 F.col("n").alias(f"n{x}"))
    size = sets.select("node", "n")
    fit = (pairs.join(size.withColumnsRenamed({"node": "a", "n": "na"}), "a")
           .join(size.withColumnsRenamed({"node": "b", "n": "nb"}), "b")
           .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b"))
    j = fit.join(side("a"), "a").join(side("b"), "b")
    most = bound("ha", "hb", "na", "nb")
    return j.withColumn("most", most).where(
        100 * F.col("most") >= percent * (F.col("na") + F.col("nb") - F.col("most"))).select("a", "b")


def verified(pairs: DataFrame, profiles: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v) set keys, u > v, of the (a, b) pairs that are similar enough."""
    pairs = cut(promising(pairs, profiles, percent), "pairs")
    sets = shingle_sets(docs, size, profiles, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    a = sets.select(F.col("node").alias("a"), F.col("key").alias("ka"),
                    F.col("s").alias("sa"), F.col("n").alias("na"))
    b = sets.select(F.col("node").alias("b"), F.col("key").alias("kb"),
                    F.col("s").alias("sb"), F.col("n").alias("nb"))
    both = F.size(F.array_intersect("sa", "sb"))
    links = cut(pairs.join(a, "a").join(b, "b")
                .where(100 * both >= percent * (F.col("na") + F.col("nb") - both))
                .select(F.greatest("ka", "kb").alias("u"), F.least("ka", "kb").alias("v"))
                .where("u > v"), "verified")
    discard(pairs, sets)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node but the smallest of its component, with the smallest.

    Alternating large-star and small-star steps until the edges are stars.
    """
    edges = cut(edges.distinct(), "links")
    mark = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark or not state[0]:
            return edges
        mark = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select(
            "u", F.least("u", "w").alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(joined.select("u", F.col("m").alias("v"))))
        old, edges = edges, cut(small.distinct(), "links")
        discard(old)


def with_roots(sets: DataFrame, links: DataFrame) -> DataFrame:
    """node, key, n, root of the candidate sets."""
    return (sets.select("node", "key", "n")
            .join(links, F.col("key") == F.col("u"), "left")
            .select("node", "key", "n", F.coalesce("v", "key").alias("root")))


def families(group: DataFrame, roots: DataFrame) -> DataFrame:
    """(hub, node, n, root, out): members of the signature groups that reach over several components.

    ``out``: the member is outside its hub's component.  The hub has met every member.
    """
    g = group.join(roots.select("node", "root", "n"), "node")
    wide = g.groupBy("sig").agg(F.min("node").alias("hub"), F.min("root").alias("lo"),
                                F.max("root").alias("hi")).where("lo <> hi").select("sig", "hub")
    home = roots.select(F.col("node").alias("hub"), F.col("root").alias("home"))
    return cut(g.join(wide, "sig").select("hub", "node", "n", "root").where("hub <> node").distinct()
               .join(home, "hub").withColumn("out", F.col("root") != F.col("home")).drop("home"), "members")


def dealt(member: DataFrame, payload: DataFrame) -> DataFrame:
    """Outsiders against all members of a hub, in pairs of chunks (hub, i, j) of ``CHUNK`` shingles."""
    size = cut(member.groupBy("hub").agg(
        F.ceil(F.sum("n") / CHUNK).alias("all_chunks"),
        F.ceil(F.sum(F.when(F.col("out"), F.col("n"))) / CHUNK).alias("out_chunks")).where(
        "out_chunks > 0"), "families")
    member = member.join(size, "hub")
    chunk = lambda total: F.pmod(F.xxhash64("node"), F.col(total)).alias
    every = lambda total: F.explode(F.sequence(F.lit(0), F.col(total) - 1)).alias
    left = member.where("out").select("hub", "node", "root", F.lit(True).alias("left"),
                                      chunk("out_chunks")("i"), every("all_chunks")("j"))
    right = member.select("hub", "node", "root", F.lit(False).alias("left"),
                          every("out_chunks")("i"), chunk("all_chunks")("j"))
    return left.unionByName(right).join(payload, "node")


def rest(group: DataFrame, profiles: DataFrame, roots: DataFrame, docs: DataFrame, size: int,
         percent: int) -> DataFrame:
    """(u, v) links between a hub's members in different components.

    First on the sets' profiles: only members that some profile of another component
    allows to link stay; then exactly, on the shingles of those.
    """
    member = families(group, roots)

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = near_nodes(pdf[pdf["left"]], pdf[~pdf["left"]], percent)
        return pd.DataFrame({"hub": np.full(len(nodes), pdf["hub"].iloc[0]), "node": nodes})

    alive = (dealt(member, profiles.select("node", "h", F.col("n").alias("size"))).groupBy("hub", "i", "j")
             .applyInPandas(near, "hub long, node long").distinct())
    every, member = member, cut(member.join(alive, ["hub", "node"], "left_semi"), "members")
    discard(every)
    sets = shingle_sets(docs, size, profiles, member.select("node").distinct())

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        return linked_pairs(pdf[pdf["left"]], pdf[~pdf["left"]], percent)

    return (dealt(member, sets.select("node", "key", "s")).groupBy("hub", "i", "j")
            .applyInPandas(link, "u binary, v binary").distinct())


def near_nodes(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> np.ndarray:
    """Nodes of left and right rows with a partner of another root that their profiles allow."""
    if not len(left) or not len(right):
        return np.empty(0, np.int64)
    sizes, nodes = right["size"].to_numpy(), right["node"].to_numpy()
    codes = pd.factorize(pd.concat([left["root"], right["root"]]))[0]
    left_roots, roots = codes[:len(left)], codes[len(left):]
    bits = np.array([-1 if h is None else len(h).bit_length() - 1 for h in right["h"]])
    tables: dict = {}           # (bits of the rows, bits folded to) -> matrix of profiles

    def table(rows_of: int, to: int) -> np.ndarray:
        if (rows_of, to) not in tables:
            at = np.flatnonzero(bits == rows_of)
            m = np.stack([np.frombuffer(right["h"].iloc[i], np.uint8) for i in at]).astype(np.int32)
            tables[rows_of, to] = m.reshape(len(at), 1 << to, -1).sum(axis=2)
        return tables[rows_of, to]

    alive = set()
    for node, root, h, n in zip(left["node"], left_roots, left["h"], left["size"]):
        fits = (np.minimum(sizes, n) * 100 >= np.maximum(sizes, n) * percent) & (roots != root)
        if not fits.any():
            continue
        most = np.minimum(sizes, n)
        own = -1 if h is None else len(h).bit_length() - 1
        for b in np.unique(bits[fits]):
            if b < 0 or own < 0:
                continue
            at, to = np.flatnonzero(bits == b), min(b, own)
            mine = np.frombuffer(h, np.uint8).astype(np.int32).reshape(1 << to, -1).sum(axis=1)
            pick = fits[at]
            most[at[pick]] = np.minimum(table(b, to)[pick], mine).sum(axis=1)
        hit = fits & (100 * most >= percent * (n + sizes - most))
        if hit.any():
            alive.add(node)
            alive.update(nodes[hit])
    return np.array(sorted(alive), np.int64)


def linked_pairs(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of left with right rows that join two components (as few as do it)."""
    out: list[tuple[bytes, bytes]] = []
    if len(left) and len(right):
        sets = [np.asarray(s) for s in right["s"]]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        owner, flat = owner[order], flat[order]
        home = {r: r for r in {*left["root"], *right["root"]}}

        def top(r):
            while home[r] != r:
                home[r] = r = home[home[r]]
            return r

        keys, roots = list(right["key"]), list(right["root"])
        for key, root, s in zip(left["key"], left["root"], left["s"]):
            s = np.asarray(s)
            at, to = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
            n = to - at
            hits = owner[np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())]
            common = np.bincount(hits, minlength=len(sets))
            for i in np.flatnonzero(100 * common >= percent * (len(s) + sizes - common)):
                a, b = top(root), top(roots[i])
                if a != b:
                    home[a] = b
                    out.append((max(key, keys[i]), min(key, keys[i])))
    return pd.DataFrame(out, columns=["u", "v"])


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """uid, id, n_shingles, root: rows with equal root are one class (null: alone)."""
    return numbered_classes(cut(docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
        F.col(text_col).cast("binary").alias("raw")), "rows"), size, percent)


def numbered_classes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """:func:`classes` of a written table of uid, id and raw (the text's bytes).

    It is read several times.  Row numbers are read from it and never made
    anew: they follow the file splits, which may differ from scan to scan.
    """
    spark = docs.sparkSession
    rows = cut(described(docs, size), "sets")
    reclaim(spark)       # shuffle files of whatever ran before, ahead of the largest shuffle
    by_sig = Window.partitionBy("sig")
    group = cut(signed(docs, size, percent)
                .withColumn("lo", F.min("node").over(by_sig))
                .withColumn("hi", F.max("node").over(by_sig))
                .where("lo < hi").select("sig", "node").distinct(), "groups")
    reclaim(spark)
    profiles = cut(profiled(rows, group.select("node").distinct()), "profiles")
    hubs = group.groupBy("sig").agg(F.min("node").alias("b"))
    star = group.join(hubs, "sig").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    links = components(verified(star, profiles, docs, size, percent))
    reclaim(spark)
    found = cut(rest(group, profiles, cut(with_roots(profiles, links), "roots"), docs, size, percent), "links")
    discard(profiles, group)
    reclaim(spark)
    if not found.isEmpty():
        links = components(links.unionByName(found))
    return (rows.join(links.withColumnRenamed("u", "key"), "key", "left")
            .select("uid", "id", "n_shingles", F.coalesce("v", "key").alias("root")))


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: id, n_shingles, component_id."""
    rows = classes(docs, id_col, text_col, size, percent)
    least = (rows.where(F.col("root").isNotNull()).groupBy("root")
             .agg(F.min("id").alias("component_id")))
    return (rows.join(least, "root", "left")
            .select(F.col("id").alias(id_col), "n_shingles",
                    F.when(F.col("root").isNull(), F.col("id"))
                    .otherwise(F.col("component_id")).alias("component_id")))


def op4_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Contract query: the class of every document."""
    return joined(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class the document with the smallest id stays."""
    uid = fresh(docs, "_uid")
    table = cut(docs.withColumn(uid, F.monotonically_increasing_id()), "rows")
    rows = numbered_classes(table.select(
        F.col(uid).alias("uid"), F.col("doc_id").alias("id"),
        F.col("text").cast("binary").alias("raw")), STAGE_SHINGLE, STAGE_PERCENT)
    # one row per class by an aggregate, not a window: a class may be a third of all rows
    keep = rows.where(F.col("root").isNotNull()).groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("uid"))).alias("k")).select(
        "root", F.col("k.uid").alias("first"))
    drop = rows.join(keep, "root").where("uid <> first").select(F.col("uid").alias(uid))
    return table.join(drop, uid, "left_anti").select(*docs.columns)
