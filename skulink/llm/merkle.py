"""Merkle manifest of a dataset by slot pivots (operator 12).

Every row is a leaf; the leaves of a source, in order, form a tree of fanout
3; the subroots of all sources, in order, form the tree of the root.

A parent's children are spread into fanout columns by conditional aggregates,
``max(hash) filter (slot = i)``.  All columns concatenated hash to the parent;
leaving a node's own column out gives its siblings.  Going up, the pivot is
a grouping (rows shrink by three a level); for the proofs it is the same
aggregates over windows, so each node sees its parent's columns without a join.

A block is ``FANOUT ** LEVELS`` (729) neighbouring nodes of one tree.  Nodes are
shuffled once per block, and all six levels of the block run inside that
partitioning; the block's parents are the nodes of the next round.  No task
holds more than blocks of 729 nodes, whatever share of rows a source has, and
a table of 10^11 rows takes four rounds.  Ranks inside a source come from a
range shuffle by (source, id), counted per partition, so a hot source is
spread over the partitions it needs.

Defined results: a null field is ``-``; a null source is a tree of its own, before
all others; a null id sorts first, has no tampering and keeps its row; equal
ids are ordered by leaf; repeated rows are leaves of their own (which of two
equal rows comes first cannot be seen in their hashes but for their proofs, which are
dealt among them); texts are hashed whole; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skulink.session import cut

FANOUT, LEVELS = 3, 6
BLOCK = FANOUT ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    v = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def leaf_of(columns: dict[str, Column]) -> Column:
    return digest(*[field(columns[c]) for c in FIELDS])


def group_key(source: Column) -> Column:
    """Never null, ordered like the source: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, *order, ...) with ``pos`` (gapless from 0) and ``n`` per tree.

    A range shuffle puts neighbours together; partitions are numbered, and a
    partition's share of a tree starts where the partitions before it end.  Equal
    rows are spread by a tie-breaker, so no key is too big for a partition.
    """
    rows = cut(rows, "merkle-nodes")     # the range shuffle reads its input twice
    dealt = cut(rows.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
                .repartitionByRange("tree", *order, "tie")
                .withColumn("part", F.spark_partition_id()), "merkle-ranges")
    share = dealt.groupBy("tree", "part").agg(F.count("*").alias("m"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    share = share.select("tree", "part",
                         F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"),
                         F.sum("m").over(whole).alias("n"))
    inside = Window.partitionBy("tree", "part").orderBy(*order, "tie")
    return (dealt.withColumn("at", F.row_number().over(inside) - 1).join(share, ["tree", "part"])
            .withColumn("pos", (F.col("start") + F.col("at")).cast("long"))
            .drop("tie", "part", "start", "at", "m"))


def above(j: int) -> str:
    return f"up{j}"


def located(nodes: DataFrame, shuffle: bool = True) -> DataFrame:
    """Each node's ancestors' positions in its block, one shuffle per block."""
    out = nodes.withColumns({above(j): F.expr(f"pos div {FANOUT ** j}")
                             for j in range(1, LEVELS + 1)})
    return out.repartition("tree", above(LEVELS))


def keys(j: int) -> list[str]:
    """Grouping columns at level j, coarse to fine: every level's order is a prefix of the finer one."""
    return ["tree"] + [above(i) for i in range(LEVELS, j - 1, -1)]


def slot_of(j: int) -> Column:
    """A node's slot under its parent at level j."""
    return (F.col("pos") if j == 1 else F.col(above(j - 1))) % FANOUT


def pivot(value: Column, slot: Column) -> list[Column]:
    """The parent's children as fanout columns (conditional aggregates)."""
    return [F.max(F.when(slot == i, value)) for i in range(FANOUT)]


def grows(j: int) -> Column:
    """Whether several nodes remain before level j."""
    return F.col("n") > FANOUT ** (j - 1)


def parent_of(slots: list[Column], j: int) -> Column:
    return F.when(grows(j), digest(*[F.coalesce(s, F.lit("")) for s in slots])).otherwise(slots[0])


def climb(nodes: DataFrame) -> DataFrame:
    """(tree, pos, hash, n) to the nodes ``LEVELS`` levels up; a finished tree keeps its root."""
    level = located(nodes.select("tree", "pos", "hash", "n"))
    for j in range(1, LEVELS + 1):
        spread = [c.alias(f"c{i}") for i, c in enumerate(pivot(F.col("hash"), slot_of(j)))]
        level = level.groupBy(*keys(j)).agg(F.max("n").alias("n"), *spread)
        level = level.withColumn("hash", parent_of([F.col(f"c{i}") for i in range(FANOUT)], j)).drop(
            *[f"c{i}" for i in range(FANOUT)])
    return level.select("tree", F.col(above(LEVELS)).alias("pos"), "hash",
                        F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"))


def with_paths(nodes: DataFrame) -> DataFrame:
    """Adds ``path``, the siblings left and right of the node and its ancestors inside the block."""
    level = located(nodes).withColumns({"hash_": F.col("hash"), "path": F.array().cast(PATH)})
    for j in range(1, LEVELS + 1):
        w = Window.partitionBy(*keys(j))
        level = level.withColumns({f"c{i}": c.over(w) for i, c in enumerate(
            pivot(F.col("hash_"), slot_of(j)))})
        cols = [F.coalesce(F.col(f"c{i}"), F.lit("")) for i in range(FANOUT)]
        left = F.concat(*[F.when(slot_of(j) > i, cols[i]).otherwise("") for i in range(FANOUT)])
        right = F.concat(*[F.when(slot_of(j) < i, cols[i]).otherwise("") for i in range(FANOUT)])
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        level = level.withColumns({
            "path": F.when(grows(j), F.concat("path", step)).otherwise(F.col("path")),
            "hash_": parent_of([F.col(f"c{i}") for i in range(FANOUT)], j),
        }).drop(*[f"c{i}" for i in range(FANOUT)])
    return level.drop("hash_", *[above(j) for j in range(1, LEVELS)])


def rounds_of(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of each round, leaves first; the last has one node per tree."""
    out = [nodes]
    left = nodes.agg(F.max("n")).first()[0] or 1
    while left > 1:
        out.append(cut(climb(out[-1]), "merkle-round"))
        left = -(-left // BLOCK)
    return out


def proofs(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves' rows with their whole ``path`` and the columns of ``tops`` (tree, path, ...)."""
    extra = [c for c in tops.columns if c not in ("tree", "path")]
    known = rounds[-1].drop("hash", "n").join(tops, "tree") if len(rounds) > 1 else None
    for i, nodes in reversed(list(enumerate(rounds[:-1]))):
        up = known.select("tree", F.col("pos").alias(above(LEVELS)), F.col("path").alias("rest"), *extra)
        known = (with_paths(nodes).join(up, ["tree", above(LEVELS)])
                 .withColumn("path", F.concat("path", "rest")).drop("rest", above(LEVELS)))
        if i:
            known = cut(known.drop("hash", "n"), "merkle-paths")
    return known if known is not None else rounds[0].join(tops, "tree")


def manifest(rows: DataFrame) -> DataFrame:
    """``rows`` (tree, hash, order columns in ``id``, others) with pos, subroot, root and path.

    ``path`` lists, level by level up to the root, the siblings left and right of the
    row's ancestors as concatenated hashes.
    """
    numbered = cut(ranked(rows, ["id", "hash"]), "merkle-leaves")
    rounds = rounds_of(numbered)
    subroots = rounds[-1].select(F.col("tree").alias("source_key"), F.col("hash"))
    top = cut(ranked(subroots.withColumn("tree", F.lit("")), ["source_key"]), "merkle-sources")
    top_rounds = rounds_of(top)
    root = top_rounds[-1].select("tree", F.col("hash").alias("root"), F.array().cast(PATH).alias("path"))
    tops = cut(proofs(top_rounds, root).select(
        F.col("source_key").alias("tree"), F.col("hash").alias("subroot"), "root", "path"), "merkle-tops")
    return proofs(rounds, tops)


def folded(leaf: Column, path: Column) -> Column:
    """The root recomputed from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def op12_merkle(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document's leaf, roots and proof, checked after the contract's tampering."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = {c: F.col(c) for c in FIELDS}
    now = leaf_of(at | {"text": F.regexp_replace("text", "\n", "")})
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    rows = docs.select(group_key(F.col("source")).alias("tree"), F.col("doc_id").alias("id"),
                       leaf_of(at).alias("hash"), F.when(hit, now).alias("now"))
    out = manifest(rows)
    out = out.withColumn("fold", folded(F.coalesce("now", "hash"), F.col("path")))
    return out.select(F.col("id").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", "root",
                      F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
                      F.col("fold").alias("folded_root"), (F.col("fold") == F.col("root")).alias("verified"))
