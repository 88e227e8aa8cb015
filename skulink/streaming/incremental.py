"""Incremental matching of a growing base catalogue (S10/S11 as a stream).

The sequential job kept text files of finished thresholds and matched
products so a re-run could skip them.  Here that bookkeeping is Spark's:
new base-catalogue files are picked up by a file-source stream, the
stream's checkpoint records which files are done, and every micro-batch
runs the closed-form cascade (policy ``none``: a left row's result depends
only on the vendor catalogue, so batches are independent).  Left products
already present in the output are skipped (the matched-id set, S11).

Each batch writes into its own ``batch_id=<n>`` folder with overwrite and
skips only what earlier batches (smaller numbers) have matched with the same
vendor, so a batch replayed after a failure gives and replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skulink.plans.cascade import attach_rows, match_none
from skulink.sources.resume import folder_names

LEFT_SCHEMA = T.StructType([
    T.StructField("pos", T.LongType()),
    T.StructField("vendor", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in
      ["product_category", "product_sub_category", "product_id", "product_name",
       "product_quantity", "product_price", "product_url", "image_url", "product_desc"]],
])


def _batch_path(out_path: str, batch_id: int) -> str:
    return f"{out_path.rstrip('/')}/batch_id={batch_id}"


def done_before(spark: SparkSession, out_path: str, batch_id: int) -> DataFrame | None:
    """Log rows (vendor, kind, key) of the ids that earlier batches matched."""
    numbers = [int(n.split("=")[1]) for n in folder_names(spark, out_path)
               if n.startswith("batch_id=")]
    earlier = [_batch_path(out_path, b) for b in sorted(numbers) if b < batch_id]
    if not earlier:
        return None
    return (spark.read.parquet(*earlier).where(F.col("match_k").isNotNull())
            .select("vendor", F.lit("id").alias("kind"), F.col("left_product_id").alias("key"))
            .distinct())


def match_batch(batch: DataFrame, right: DataFrame, out_path: str, batch_id: int,
                **match_kwargs) -> None:
    """One micro-batch: skip done products, match, write this batch's folder."""
    done = done_before(batch.sparkSession, out_path, batch_id)
    out = attach_rows(match_none(batch, right, done=done, **match_kwargs), right)
    out.write.mode("overwrite").parquet(_batch_path(out_path, batch_id))


def match_stream(spark: SparkSession, left_dir: str, right: DataFrame, out_path: str,
                 checkpoint_location: str, fmt: str = "parquet", available_now: bool = True,
                 **match_kwargs) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops."""
    reader = spark.readStream.schema(LEFT_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    stream = reader.format(fmt).load(left_dir)
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: match_batch(df, right, out_path, bid, **match_kwargs))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
