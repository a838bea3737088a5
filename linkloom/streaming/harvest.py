"""Incremental harvest as a stream: new files of messages, each message once, a cursor for each channel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def harvested(spark: SparkSession, folder: str, pattern: str, schema: str, state: str, key: str = "event_id") -> DataFrame:
    """All messages harvested so far, after taking what is new in folder.

    Runs until the files of now are read and stops; a rerun goes on where the last one ended. A batch that is repeated writes
    the same folder again, so each message is held once for each batch, and repeats across batches are dropped on reading.
    """
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)

    def take(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates([key]).write.mode("overwrite").parquet(f"{state}/held/batch={number}")

    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{state}/held").drop("batch").dropDuplicates([key])


def windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts by event-time window and type; works on a stream, with its watermark, and on a table."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
