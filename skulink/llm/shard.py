"""Sharding by a hierarchical weighted hash tree (operator 10).

A tree has three levels: region, rack, shard; a shard carries a weight and
every inner node weighs what its children weigh together.  A row walks down
from the root: at each node every child draws ``ln(u) / weight`` with ``u``
uniform in (0, 1] from the MD5 of ``key|child path``, and the largest draw
wins.  A child's draw depends on nothing but the key, its own path and its
own weight, so changing weights inside one subtree moves rows only into or
out of the nodes whose weight changed.  A shard added as a region of its own
changes no other draw at all: it takes rows only into itself (law ``key``).

Everything is built-in functions.  Slots (gapless numbers inside a shard)
come from two levels: rows are dealt evenly into hash buckets, a bucket is
numbered by a window, and bucket offsets are a running sum over the bucket
counts, so no task ever holds a whole shard.

Defined results: a null id draws as the empty key; null and empty text have
size 1 and CRC 0; repeated rows share the shard and get slots of their own;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skulink.session import cut

# production topology: 2 regions x 2 racks x 2 shards of equal weight
TREE = {"r0": {"k0": {0: 1.0, 1: 1.0}, "k1": {2: 1.0, 3: 1.0}},
        "r1": {"k0": {4: 1.0, 5: 1.0}, "k1": {6: 1.0, 7: 1.0}}}
# one more shard arrives as a region of its own
GROWN = {**TREE, "r2": {"k0": {8: 1.0}}}


def node_weight(node) -> float:
    return sum(node_weight(c) for c in node.values()) if isinstance(node, dict) else float(node)


def draw(key: Column, path: str, weight: float) -> Column:
    """``ln(u) / weight``: the largest of several is a weighted random choice."""
    digest = F.md5(F.concat(key, F.lit("|" + path)))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1.0) / float(2 ** 52)
    return F.log(u) / F.lit(weight)


def descend(key: Column, node, path: str = "") -> Column:
    """The shard number reached from ``node``; only the chosen branch is evaluated."""
    if not isinstance(node, dict):
        raise TypeError("a shard has no children")
    names = [n for n in node if node_weight(node[n]) > 0]
    if not names:
        raise ValueError(f"no positive weight below {path or 'the root'}")
    leaf = lambda n: (F.lit(int(n)) if not isinstance(node[n], dict)
                      else descend(key, node[n], f"{path}/{n}"))
    if len(names) == 1:
        return leaf(names[0])
    draws = [draw(key, f"{path}/{n}", node_weight(node[n])) for n in names]
    best = F.greatest(*draws)
    out = leaf(names[-1])
    for n, d in reversed(list(zip(names[:-1], draws[:-1]))):
        out = F.when(d == best, leaf(n)).otherwise(out)
    return out


def key_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           tree: dict = TREE, grown: dict = GROWN, buckets: int | None = None) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 1.  ``buckets`` is the number of
    numbering buckets per shard (default: the session's shuffle partitions);
    it sets the work per task and cannot change which shard a row is in.
    """
    spark = docs.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text, key = F.coalesce(F.col(text_col).cast("string"), F.lit("")), key_of(id_col)
    rows = cut(docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("crc"),
        descend(key, tree).alias("shard"),
        descend(key, grown).alias("grown_shard"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")), "shard-rows")
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket",
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    order = Window.partitionBy("shard", "bucket").orderBy("id", "crc", "row")
    return (rows.withColumn("pos", F.row_number().over(order))
            .join(offsets, ["shard", "bucket"])
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("start") + F.col("pos") - 1).cast("long").alias("slot"),
                    "grown_shard"))


def op10_shard(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document placed by the law ``key``."""
    out = assign(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                      "grown_shard")
