"""An incremental run as a stream: new files since the last run, once, in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def available_now(spark: SparkSession, path: str, schema: str, checkpoint: str, handle) -> None:
    """Calls ``handle(frame, batch number)`` for what is new below ``path``, then stops.  Files are told apart by path:
    content that changes in place is the manifest's business."""
    rows: DataFrame = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)
    rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
