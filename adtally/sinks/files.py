"""Text and partitioned outputs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_files(df: DataFrame, files: int | None) -> DataFrame:
    """Spread a result over a fixed number of files.

    ``repartition`` and not ``coalesce``: coalescing would also run the steps before it on that
    few tasks. Without a number the adaptive plan picks the count.
    """
    return df if files is None else df.repartition(files)


def with_file_ratio(df: DataFrame, tasks: int, part: int) -> DataFrame:
    """One file per ``part`` of the ``tasks`` that produce the result, at least one."""
    return with_files(df, max(1, tasks // part))


def write_lines(
    df: DataFrame, path: str, files: int | None = None, gzip: bool = False, separator: str = "\t"
) -> None:
    """Overwrite a folder of text lines; several columns are joined by ``separator``."""
    columns = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in df.columns]
    lines = with_files(df, files).select(F.concat_ws(separator, *columns).alias("value"))
    lines.write.mode("overwrite").text(path, compression="gzip" if gzip else None)


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    with_files(df, files).write.mode("overwrite").csv(path)


def replace_partitions(
    df: DataFrame, path: str, by: Sequence[str] = ("d", "h"), spread: bool = True
) -> None:
    """Replace the partitions that occur in ``df`` and leave the others as they are.

    Rows are first spread by the partition columns, so that each task writes few partitions. A
    large day is not forced into one task: the rebalance hint lets the adaptive plan split it.
    Without ``spread`` every task writes what it has, which saves the shuffle where all rows
    belong to one partition.
    """
    rows = df.hint("rebalance", *by) if spread else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def partitioned_table(like: DataFrame, name: str, path: str, by: str = "d") -> None:
    """An external table whose partitions are added by ``switch_partition``."""
    columns = ", ".join(f"`{column}` {kind}" for column, kind in like.dtypes)
    like.sparkSession.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{by}`) LOCATION '{path}'")


def switch_partition(df: DataFrame, name: str, path: str, by: str, value: str) -> str:
    """Give a partition of the table new rows, written beside the old ones first; gives their folder.

    The partition then points to the new folder in one step, so readers find the old rows or the new ones, never some
    of each. The old files stay for readers that were planned before; whoever knows that there are none may delete them.
    """
    spark = df.sparkSession
    folder = f"{path}/{by}={value}/{uuid.uuid4().hex}"
    df.drop(by).write.parquet(folder)
    part = f"PARTITION (`{by}` = '{value}')"
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part} LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {name} {part} SET LOCATION '{folder}'")
    return folder
