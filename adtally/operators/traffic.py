"""Traffic reports over bid requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions.dates import iso_day
from adtally.functions.labels import (
    device_daily,
    device_from_app,
    device_on_demand,
    os_class,
    os_class_request,
    placement_label,
    platform_name,
    size_label,
)
from adtally.sources.requests import ReachSpec, ReportSpec
from adtally.sources.tables import day_between, platform_table

# Dimensions every platform has, and those only the full bid table has.
COMMON_DIMENSIONS = ("day", "hour", "platform")
FULL_PLATFORM = "youku"


def dimensions(platform: str) -> dict[str, Column]:
    """Output columns a request may name."""
    columns = {"platform": F.lit(platform), "day": F.col("d"), "hour": F.col("h")}
    if platform == FULL_PLATFORM:
        columns |= {
            "device": device_on_demand(F.col("device_type")),
            "channel": F.col("channel"),
            "size": size_label(F.col("width"), F.col("height")),
            "os": os_class(F.col("os")),
            "tagid": F.col("tagid"),
            "placementid": F.col("placementid"),
        }
    return columns


def daily_traffic(bids: DataFrame, platform: str = FULL_PLATFORM) -> DataFrame:
    """Bid requests per day, placement, channel, device, system and size."""
    return (
        bids.groupBy(
            iso_day(F.col("d")).alias("day"),
            F.coalesce("tagid", F.lit("-")).alias("placement"),
            F.col("channel"),
            device_daily(F.col("device_type")).alias("device"),
            os_class(F.col("os")).alias("system"),
            F.col("width"),
            F.col("height"),
        )
        .agg(F.count("*").alias("count"))
        .withColumn("platform", F.lit(platform))
    )


def request_columns(spec: ReportSpec) -> list[str]:
    """Requested columns the platform has, in requested order."""
    known = dimensions(spec.platform)
    return [name for name in spec.columns if name in known]


def request_filter(spec: ReportSpec) -> Column:
    """Day range and the filters of the request; only the full platform has filters."""
    condition = day_between(spec.start, spec.end)
    if spec.platform == FULL_PLATFORM:
        tested = dimensions(spec.platform) | {"device": F.col("device_type")}
        for name, values in spec.filters.items():
            if values:
                condition = condition & tested[name].isin(list(values))
    return condition


def traffic_report(bids: DataFrame, spec: ReportSpec) -> DataFrame:
    """Bid requests per requested column."""
    platform_table(spec.platform)
    known = dimensions(spec.platform)
    names = request_columns(spec)
    groups = [known[name].alias(name) for name in names if name != "platform"]
    counts = bids.where(request_filter(spec)).groupBy(*groups).agg(F.count("*").alias("count"))
    if not groups:
        counts = counts.where("count > 0")
    return counts.withColumn("platform", F.lit(spec.platform)).select(*names, "count")


def display_rows(report: DataFrame) -> DataFrame:
    """Report rows as delivered: dashes in the day, the platform's display name."""
    shown = {"day": iso_day(F.col("day")), "platform": platform_name(F.col("platform"))}
    return report.select(
        *[shown.get(name, F.col(name)).alias(name) for name in report.columns]
    )


def reach_rows(bids: DataFrame, spec: ReachSpec) -> DataFrame:
    """Bid requests that pass the lists of a reach request, with its labels."""
    labels = bids.select(
        F.col("channel"),
        F.col("h").alias("hour"),
        device_from_app(F.col("site_or_app_name")).alias("device"),
        size_label(F.col("width"), F.col("height")).alias("size"),
        F.when(F.coalesce("os", F.lit("")) == "", "Other")
        .otherwise(os_class_request(F.col("os"))).alias("system"),
        placement_label(F.col("tagid"), F.col("channel")).alias("placementid"),
        F.col("keywords"),
    )
    for name in ("channel", "device", "size", "system", "placementid"):
        wanted = getattr(spec, name)
        if wanted:
            labels = labels.where(F.col(name).isin(list(wanted)))
    return labels
