"""Dense numbers in a given order, without a sort of all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.session import materialize


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``, their number from 1 in the given order.

    The rows are range partitioned by that order and written with their slice number; a row's number
    is the size of all earlier slices plus its rank in its own. Only the slice sizes, one row per
    slice, pass through a single task.
    """
    slices = materialize(
        rows.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), f"{name}-slices"
    )
    sizes = slices.groupBy("_slice").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    return slices.join(starts, "_slice").select(*rows.columns, (F.col("_start") + rank).alias(name))
