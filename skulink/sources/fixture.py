"""Catalogues, hits and pages derived from the driver's parquet tables.

The matching jobs read product catalogues; the test tables are TPC-H-like,
so ``part`` gives the products and the words of ``documents`` lengthen
names and descriptions (rules in FIXTURES.md).  Everything here is a plain
DataFrame plan over the given tables, so its size grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skulink.functions.text import WORD_SPLIT
from skulink.session import cut

# Fixture labels (ours): the base catalogue and up to six vendors.
BASE_LABEL = "Base"
VENDORS = ["Alpha", "Beta", "Gamma", "Delta", "Epsilon", "Zeta"]
URL_BASE = "https://shop.example/p/"
IMAGE_BASE = "https://img.example/p/"

CATALOGUE_COLUMNS = ["pos", "vendor", "product_category", "product_sub_category",
                     "product_id", "product_name", "product_quantity",
                     "product_price", "product_url", "image_url", "product_desc"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts with ``name_words``, the words of their document that their names take."""
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_docs = F.lit(max(1, docs.count()))          # answered by the Parquet footers
    # texts are moved as they are and cut to a name's words before the next join, which moves only those
    nd = docs.select(F.col("doc_id").alias("n_doc"), F.col("text").alias("n_text"))
    p = p.join(nd, nd.n_doc == F.expr("p_partkey div 2") % n_docs, "left").withColumn(
        "nw", F.filter(F.split("n_text", WORD_SPLIT), lambda w: w != ""))
    # four to eight words from anywhere in the document
    name_words = F.array_join(F.slice(
        F.coalesce("nw", F.array().cast("array<string>")),
        (F.lit(1) + (F.expr("p_partkey div 2") * 31) % F.greatest(F.lit(1), F.size("nw") - 12)
         + k % 3).cast("int"), (F.lit(4) + k % 5).cast("int")), " ")
    return p.withColumn("name_words", name_words).drop("n_doc", "n_text", "nw")


def fixture_catalogue(spark: SparkSession, sf_dir: str, names: DataFrame | None = None) -> DataFrame:
    """All parts as catalogue rows (left and right are split by ``pos``).

    ``names``: the rows of :func:`fixture_names`, where they have been written before.
    Parts 2m and 2m + 1 (one of the base, one of the vendors) take overlapping
    words of document m modulo the number of documents into their names, and
    part k has document 3k as description, whole, so every document is used as
    the tables grow; both are equi-joins on ``doc_id``.
    """
    p = fixture_names(spark, sf_dir) if names is None else names
    k = F.col("p_partkey")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_docs = F.lit(max(1, docs.count()))
    dd = docs.select(F.col("doc_id").alias("d_doc"), F.col("text").alias("d_text"))
    p = p.join(dd, dd.d_doc == (k * 3) % n_docs, "left")
    measure = (F.when(k % 4 == 0, F.concat(F.col("p_size"), F.lit(" mL")))
                .when(k % 4 == 1, F.concat(F.col("p_size"), F.lit(".5 mm")))
                .when(k % 4 == 2, F.concat(F.lit("No "), F.col("p_size")))
                .otherwise(F.col("p_brand")))
    name = F.concat_ws(" ",
                       F.when(k % 7 < 5, F.col("p_name")),
                       F.when(k % 3 == 0, F.lower("p_type")),
                       measure, F.col("name_words"))
    desc = F.when(k % 11 != 0, F.col("d_text"))
    pid = F.concat(F.lit("P"), k.cast("string"))
    return p.select(
        k.alias("pos"),
        F.lit(BASE_LABEL).alias("vendor"),
        F.col("p_type").alias("product_category"),
        F.col("p_brand").alias("product_sub_category"),
        pid.alias("product_id"),
        name.alias("product_name"),
        F.col("p_size").cast("string").alias("product_quantity"),
        F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("product_price"),
        F.concat(F.lit(URL_BASE), k.cast("string")).alias("product_url"),
        F.concat(F.lit(IMAGE_BASE), k.cast("string"), F.lit(".jpg")).alias("image_url"),
        desc.alias("product_desc"),
    )


def fixture_left(spark: SparkSession, sf_dir: str, names: DataFrame | None = None) -> DataFrame:
    """Base catalogue: even ``pos``."""
    return fixture_catalogue(spark, sf_dir, names).where(F.col("pos") % 2 == 0)


def fixture_right(spark: SparkSession, sf_dir: str, n_vendors: int = 1,
                  names: DataFrame | None = None) -> DataFrame:
    """Vendor catalogue(s): odd ``pos``; ``n_vendors`` > 1 splits by ``(pos div 2) % n``."""
    right = fixture_catalogue(spark, sf_dir, names).where(F.col("pos") % 2 == 1)
    labels = F.array(*[F.lit(v) for v in VENDORS[:n_vendors]])
    vendor = F.element_at(labels, (F.expr("(pos div 2)") % n_vendors + 1).cast("int"))
    return right.withColumn("vendor", vendor)


def fixture_sides(spark: SparkSession, sf_dir: str, n_vendors: int = 1) -> tuple[DataFrame, DataFrame]:
    """Base and vendor catalogues for a job that reads them more than once: the words of all names
    are taken from the documents once and written."""
    names = cut(fixture_names(spark, sf_dir), "catalogue-names")
    return fixture_left(spark, sf_dir, names), fixture_right(spark, sf_dir, n_vendors, names)


def fixture_hits(spark: SparkSession, sf_dir: str, vendor: str = VENDORS[0],
                 by: str = "product_id") -> DataFrame:
    """Search hits per left product: three ranked right ids, none when key % 3 = 1.

    The ids run over the whole vendor catalogue.  ``by`` is the query text:
    the product's id or its name.
    """
    p = table(spark, sf_dir, "part").select("p_partkey")
    k = F.col("p_partkey")
    n_right = F.lit(max(1, p.where(k % 2 == 1).count()))
    p = p.where((k % 2 == 0) & (k % 3 != 1))
    rank = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("rank")
    right_key = F.lit(2) * ((k * 7 + F.col("rank") * 13) % n_right) + 1
    hits = p.select(k, rank).select(
        k.alias("_k"), F.lit(vendor).alias("vendor"),
        F.concat(F.lit("P"), k.cast("string")).alias("query_key"),
        F.col("rank").cast("int").alias("rank"),
        F.concat(F.lit("P"), right_key.cast("string")).alias("product_id"))
    if by == "product_name":
        names = fixture_left(spark, sf_dir).select(F.col("pos").alias("_k"), "product_name")
        hits = hits.drop("query_key").join(names, "_k").withColumnRenamed("product_name", "query_key")
    return hits.select("vendor", "query_key", "rank", "product_id")
