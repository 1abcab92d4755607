"""Report rows in a database.

Spark's writer can append rows or replace a whole table, nothing between. So rows are only ever
appended: counters carry the names of their stream and batch, and ``sources.jdbc.running_counts``
adds them up, each batch once. A slice is replaced in its Parquet form (``sinks.files``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_rows(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Insert rows; the write opens one connection per partition and sends batches."""
    df.write.jdbc(url, table, mode="append", properties=properties)


def named_counts(counts: DataFrame, stream_id: str, batch_id: int) -> DataFrame:
    """Counters with the names of their stream and batch."""
    return counts.withColumns({"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("long")})


def append_counts(
    counts: DataFrame, stream_id: str, batch_id: int, url: str, table: str, properties: dict[str, str]
) -> None:
    """Insert the counters of a batch at the cost of the batch; a batch that comes again does no harm."""
    append_rows(named_counts(counts, stream_id, batch_id), url, table, properties)
