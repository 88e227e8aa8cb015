"""S1 + S3 + U1: CSV files with line breaks in cells, read by many tasks, in file order.

A line break inside a quoted cell belongs to the cell, so a reader that enters a
file in the middle cannot tell where a record starts.  What it needs is one bit: whether the
number of quotes before its first byte is odd (an escaped quote is two quotes and
changes nothing).  So files are read as lines, split like any text file:

1. per file block the quotes are summed, and a running sum over the blocks of a file
   gives each block the parity it starts with;
2. inside a block a running sum over its lines gives each line its parity; a
   line that starts even starts a record;
3. running counts of record starts, over files, blocks and lines, number the
   records: gapless, in the order of file names and bytes, the same however files were split.
   Lines that start odd carry the number of the record before them;
4. only records of several lines are put together by a shuffle of those lines.

Every file's first record is its header.  Files are grouped by header, each group is
parsed once with its own names, and columns meet by name; a column that a file
lacks is empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skulink.session import cut

MAX_HEADERS = 1000       # different headers among the files (checked, not cut)
CSV_OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}


def running(value: Column, window) -> Column:
    """Sum over the rows before this one."""
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, line (order inside the block), value, odd (quotes)."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return cut(lines.withColumn("odd", (quotes % 2).cast("int")), "csv-lines")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, number (from 0, headers included, over all files), in_file, record."""
    lines = csv_lines(spark, path)
    files = Window.orderBy("file")                   # one row per file
    blocks = Window.partitionBy("file").orderBy("block")
    inside = Window.partitionBy("file", "block").orderBy("line")
    # parity inside the block, as if it started even
    lines = lines.withColumn("at", (running(F.col("odd"), inside) % 2).cast("int"))
    blank = F.rtrim("value", F.lit("\r")) == ""
    first = lambda parity: F.sum(F.when((F.col("at") == parity) & ~blank, 1).otherwise(0))
    totals = cut(lines.groupBy("file", "block").agg(
        F.sum("odd").alias("odd"), first(0).alias("even_starts"), first(1).alias("odd_starts")), "csv-blocks")
    totals = totals.withColumn("parity", (running(F.col("odd"), blocks) % 2).cast("int"))
    totals = totals.withColumn("starts", F.when(F.col("parity") == 0, F.col("even_starts"))
                               .otherwise(F.col("odd_starts")))
    before = totals.groupBy("file").agg(F.sum("starts").alias("n")).select(
        "file", running(F.col("n"), files).alias("file_start"))
    totals = totals.select("file", "block", "parity", running(F.col("starts"), blocks).alias("block_start")).join(
        before, "file")
    placed = lines.join(totals, ["file", "block"]).withColumn("at", (F.col("at") + F.col("parity")) % 2)
    starts = ((F.col("at") == 0) & ~blank).cast("int")
    count = F.sum(starts).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = (placed.withColumn("in_file", F.col("block_start") + count - 1)
              .where((F.col("at") == 1) | ~blank)
              .select("file", "block", "line", (F.col("file_start") + F.col("in_file")).alias("number"),
                      "in_file", "value", ((F.col("at") == 0) & (F.col("odd") == 0)).alias("whole")))
    parts = placed.where(~F.col("whole")).groupBy("file", "number", "in_file").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"]), "\n").alias("record"))
    out = placed.where("whole").select("file", "number", "in_file", F.col("value").alias("record")).unionByName(parts)
    return out.withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_csv(spark: SparkSession, path: str, needed: list[str]) -> DataFrame:
    """``needed`` columns as text and ``pos``, the row's ordinal over all files (headers not counted)."""
    records = cut(csv_records(spark, path), "csv-records")
    heads = cut(records.where("in_file = 0").select("file", F.col("record").alias("header")), "csv-headers")
    # headers above a row are those of its file and of the files before
    above = heads.select("file", "header", F.row_number().over(Window.orderBy("file")).alias("above"))
    rows = records.where("in_file > 0").join(above, "file").withColumn("pos", F.col("number") - F.col("above"))
    kinds = heads.select("header").distinct()
    if kinds.count() > MAX_HEADERS:
        raise ValueError(f"{path}: more than {MAX_HEADERS} different headers")
    parsed, seen = [], set()
    for header in sorted(r[0] for r in kinds.collect()):
        width = len(header.split(","))
        names = spark.range(1).select(F.from_csv(F.lit(header), ", ".join(
            f"c{i} string" for i in range(width)), CSV_OPTIONS).alias("h")).first()["h"]
        names = [n for n in names if n is not None]
        seen |= set(names)
        cells = F.from_csv("record", ", ".join(f"`{n}` string" for n in names), CSV_OPTIONS)
        part = rows.where(F.col("header") == header).select("pos", cells.alias("x"))
        parsed.append(part.select(F.col("pos").cast("long").alias("pos"), *[
            (F.coalesce(F.col("x").getField(c), F.lit("")) if c in names else F.lit("")).alias(c) for c in needed]))
    missing = [c for c in needed if parsed and c not in seen]
    if missing:
        raise ValueError(f"{path}: no file has the column {', '.join(missing)}")
    if not parsed:
        return spark.createDataFrame([], ", ".join(["pos long"] + [f"`{c}` string" for c in needed]))
    return reduce(DataFrame.unionByName, parsed)
