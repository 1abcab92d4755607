"""Names of stored batches."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH = ["stream_id", "batch_id"]


def batch_stream(spark: SparkSession) -> str:
    """Id of the query whose batch runs now."""
    stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not stream_id:
        raise RuntimeError("the batch does not name its query")
    return stream_id
