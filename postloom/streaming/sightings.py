"""Streams of crawl records into the store (R1 streaming form, R2-R5).

Files of records arrive in a folder. A trigger takes a bounded number of them (backpressure), each micro-batch is one
idempotent upsert (``foreachBatch`` with the batch id), and a run ends when everything that was there is stored (``availableNow``).
The checkpoint and the store's batch ids together make the effect of every record happen once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.operators.store import Store

RECORDS = "batch int, seq int, seen timestamp_ntz, url string, category string, title string"


def read_records(spark: SparkSession, folder: str, files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(RECORDS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def not_recent(records: DataFrame, delay: str = "1 day") -> DataFrame:
    """R1 over a stream: the first record of an address within the delay (bounded by time, where the batch form is bounded by
    count)."""
    timed = records.withColumn("_seen", F.col("seen").cast("timestamp")).withWatermark("_seen", delay)
    return timed.dropDuplicatesWithinWatermark(["url"]).drop("_seen")


def store_stream(records: DataFrame, store: Store, checkpoint: str, name: str = "sightings") -> None:
    """Store everything that is there and return."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            store.apply(batch.withColumnRenamed("title", "jobtitle"), f"{name}-{batch_id}")
        finally:
            batch.unpersist()

    query = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
