"""Land change rows with Structured Streaming and advance the high watermark.

The loaders read a high watermark per tag namespace: the newest lake time
up to which the silver source is complete.  The original reads such an
object but does not define it; this module produces it.  A streaming
landing job appends each micro-batch of new change files to the silver
source table and then raises the watermark to the newest lake time landed,
only after the rows are committed, so a loader never sees a watermark
ahead of its data.

Each micro-batch is written to its own ``_epoch=<id>`` partition with
overwrite, so a batch replayed after a failure replaces itself instead of
appending twice; the watermark is a maximum, so replaying it is harmless.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.constants import LAKE
from tidemark.sources.tables import path_exists

EPOCH = "_epoch"


def current_watermark(spark: SparkSession, path: str) -> _dt.datetime | None:
    if not path_exists(spark, path):
        return None
    row = spark.read.parquet(path).agg(F.max(LAKE).alias("m")).first()
    return row["m"] if row else None


def land_batch(batch: DataFrame, epoch_id: int, table_path: str, watermark_path: str) -> None:
    """Append one micro-batch (idempotently) and raise the watermark."""
    spark = batch.sparkSession
    newest = batch.agg(F.max(LAKE).alias("m")).first()["m"]
    if newest is None:
        return
    (
        batch.withColumn(EPOCH, F.lit(epoch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(EPOCH)
        .parquet(table_path)
    )
    # appended, never overwritten: a reader always finds one, and a stop loses none
    raised = spark.createDataFrame([(newest,)], f"{LAKE} timestamp_ntz")
    raised.coalesce(1).write.mode("append").parquet(watermark_path)


def land_with_watermark(
    spark: SparkSession,
    landing_path: str,
    schema: T.StructType,
    table_path: str,
    watermark_path: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the landing stream (``availableNow`` drains what is there and stops)."""
    stream = spark.readStream.schema(schema).parquet(landing_path)
    writer = stream.writeStream.foreachBatch(
        lambda df, epoch: land_batch(df, epoch, table_path, watermark_path)
    ).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
