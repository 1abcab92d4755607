"""Day and hour slices of partitioned tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adtally.schemas import LEGACY_COLUMNS


def day_between(start: str | None, end: str | None, column: str = "d") -> Column:
    """Inclusive day range; either end may be open."""
    day = F.col(column)
    condition = F.lit(True)
    if start:
        condition = condition & (day >= start)
    if end:
        condition = condition & (day <= end)
    return condition


def read_slice(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    start: str | None = None,
    end: str | None = None,
    hour: int | None = None,
    columns: Iterable[str] | None = None,
    legacy_names: bool = False,
) -> DataFrame:
    """Rows of a Parquet table partitioned by ``d`` and ``h``.

    The day and hour conditions prune partitions and the column list prunes the scan. With
    ``legacy_names`` columns of an existing Hive table get the names used in this package.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if legacy_names:
        df = df.withColumnsRenamed(LEGACY_COLUMNS)
    if "d" in df.columns:
        df = df.withColumn("d", F.col("d").cast("string"))
    if "h" in df.columns:
        df = df.withColumn("h", F.col("h").cast("int"))
    if start or end:
        df = df.where(day_between(start, end))
    if hour is not None:
        df = df.where(F.col("h") == hour)
    return df.select(*columns) if columns else df


def latest_partition(df: DataFrame, column: str = "d") -> DataFrame:
    """Rows of the newest partition; the maximum is a scalar subquery on the partition column."""
    newest = df.agg(F.max(column)).scalar()
    return df.where(F.col(column) == newest)


PLATFORM_TABLES = {"youku": "bid_request", "iqiyi": "bidder_iqiyi"}


def platform_table(platform: str) -> str:
    """Table that holds the bid requests of a platform."""
    if platform not in PLATFORM_TABLES:
        raise ValueError(f"no bid table for platform {platform!r}")
    return PLATFORM_TABLES[platform]
