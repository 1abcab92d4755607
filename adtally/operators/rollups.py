"""On-demand traffic reports from stored rollups of the bid requests.

Rollups are counts by day and a set of dimensions. They form a lattice: a request can be answered from every
rollup that has its columns and the columns it filters by, and each rollup from every finer one. A request
takes the smallest of those, and the bids themselves only if there is none.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.functions.labels import device_on_demand, os_class, size_label
from adtally.operators.traffic import FULL_PLATFORM, request_columns, traffic_report
from adtally.sources.requests import ReportSpec
from adtally.sources.tables import day_between, platform_table

#: Columns of a rollup, which a request may name; devices are kept as codes, which filters compare.
STORED = ("hour", "device", "channel", "size", "os", "tagid", "placementid")

CATALOG = "catalog"


@dataclass(frozen=True)
class Rollup:
    dimensions: frozenset[str]
    rows: int
    path: str


def _keys(platform: str) -> dict:
    columns = {"day": F.col("d"), "hour": F.col("h")}
    if platform == FULL_PLATFORM:
        columns |= {
            "device": F.col("device_type"), "channel": F.col("channel"), "size": size_label(F.col("width"), F.col("height")),
            "os": os_class(F.col("os")), "tagid": F.col("tagid"), "placementid": F.col("placementid"),
        }
    return columns


def store_rollups(bids: DataFrame, path: str, groupings: Iterable[Iterable[str]], platform: str = FULL_PLATFORM) -> None:
    """Store a rollup per grouping below ``path``, partitioned by day; the day is in each of them.

    Bids are read only for groupings that no other one covers; the others are added up from the smallest
    finer rollup.
    """
    spark, made = bids.sparkSession, []
    keys = _keys(platform)
    for grouping in sorted({frozenset(g) - {"day", "platform"} for g in groupings}, key=lambda g: (-len(g), sorted(g))):
        names = ["day", *(n for n in STORED if n in grouping)]
        finer = smallest(made, grouping)
        if finer is None:
            counts = bids.groupBy(*(keys[n].alias(n) for n in names)).agg(F.count("*").alias("n"))
        else:
            counts = _read(spark, finer).groupBy(*names).agg(F.sum("n").alias("n"))
        target = f"{path}/{'-'.join(names)}"
        counts.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(target)
        made.append(Rollup(grouping, spark.read.parquet(target).count(), target))
    rows = [(sorted(r.dimensions), r.rows, r.path) for r in made]
    catalog = spark.createDataFrame(rows, "dimensions array<string>, rows bigint, path string")
    catalog.coalesce(1).write.mode("overwrite").parquet(f"{path}/{CATALOG}")


def stored_rollups(spark: SparkSession, path: str) -> list[Rollup]:
    """The stored rollups; a row per grouping."""
    return [Rollup(frozenset(r.dimensions), r.rows, r.path) for r in spark.read.parquet(f"{path}/{CATALOG}").collect()]


def smallest(rollups: list[Rollup], needed: frozenset[str]) -> Rollup | None:
    """The rollup with the fewest rows that has all needed dimensions."""
    return min((r for r in rollups if needed <= r.dimensions), key=lambda r: (r.rows, r.path), default=None)


def needed_dimensions(spec: ReportSpec) -> frozenset[str]:
    """What a rollup must have: the requested columns the platform has, and those with filters."""
    filters = [n for n, values in spec.filters.items() if values] if spec.platform == FULL_PLATFORM else []
    return (frozenset(request_columns(spec)) | frozenset(filters)) - {"day", "platform"}


def _read(spark: SparkSession, rollup: Rollup) -> DataFrame:
    return spark.read.parquet(rollup.path).withColumn("day", F.col("day").cast("string"))


def rollup_report(spark: SparkSession, path: str, spec: ReportSpec, bids: DataFrame) -> DataFrame:
    """``traffic.traffic_report`` from the smallest rollup below ``path`` that can answer it, else from the bids."""
    platform_table(spec.platform)
    rollup = smallest(stored_rollups(spark, path), needed_dimensions(spec))
    if rollup is None:
        return traffic_report(bids, spec)
    condition = day_between(spec.start, spec.end, "day")
    if spec.platform == FULL_PLATFORM:
        for name, values in spec.filters.items():
            if values:
                condition = condition & F.col(name).isin(list(values))
    names = request_columns(spec)
    shown = {"device": device_on_demand(F.col("device"))}
    groups = [shown.get(n, F.col(n)).alias(n) for n in names if n != "platform"]
    counts = _read(spark, rollup).where(condition).groupBy(*groups).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"))
    if not groups:
        counts = counts.where("count > 0")
    return counts.withColumn("platform", F.lit(spec.platform)).select(*names, "count")
