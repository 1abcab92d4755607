"""Viewing profiles of devices and IP addresses.

Both profiles start from one aggregate per (device, IP, day). A second aggregate with two grouping
sets brings it to (key, partner) and (key, day) groups, a third to the key. Every step combines
before its shuffle and no step gathers the rows of one key, so an address that sends a third of
all requests is spread over all tasks until one small row per task is left of it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.functions.dates import epoch_day_number, epoch_hour
from adtally.functions.numbers import ratio2
from adtally.session import folder_exists
from adtally.sinks.files import replace_partitions
from adtally.sources.tables import day_between


def device_usage(
    bids: DataFrame,
    start: str | None = None,
    end: str | None = None,
    width: int = 640,
    height: int = 480,
    zone_offset: int = 0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Videos and hour mask per device, IP and day (and the columns ``by``), for devices with a dashed id."""
    rows = bids.where(
        day_between(start, end)
        & (F.col("width") == width)
        & (F.col("height") == height)
        & F.col("user_id").contains("-")
    )
    return rows.select(
        F.col("user_id").alias("idfa"),
        "ip",
        epoch_day_number(F.col("time_i"), zone_offset).alias("day"),
        F.call_function("shiftleft", F.lit(1), epoch_hour(F.col("time_i"), zone_offset)).alias("bit"),
        *by,
    ).groupBy("idfa", "ip", "day", *by).agg(
        F.count("*").alias("videos"), F.bit_or("bit").alias("mask")
    )


def update_usage(bids: DataFrame, path: str, start: str, end: str, **size: int) -> list[str]:
    """Store the usage of the days of a range that are not stored yet; gives those days.

    Usage is kept per day, so a profile of any range is an aggregate of stored days. Bids are read for new days only, in
    one pass. A day is known as stored by a row of its own, which also days without usage get.
    """
    spark = bids.sparkSession
    wanted = [(day(start) + dt.timedelta(n)).strftime("%Y%m%d") for n in range((day(end) - day(start)).days + 1)]
    done = set()
    if folder_exists(spark, f"{path}/days"):
        days = spark.read.schema("d string").parquet(f"{path}/days")
        done = {row.d for row in days.where(day_between(start, end)).collect()}
    new = [d for d in wanted if d not in done]
    if new:
        rows = bids.where(F.col("d").isin(new))
        replace_partitions(device_usage(rows, by=("d",), **size), f"{path}/usage", ["d"])
        replace_partitions(spark.createDataFrame([(d, d) for d in new], "d string, day string"), f"{path}/days", ["d"])
    return new


def day(compact: str) -> dt.date:
    return dt.datetime.strptime(compact, "%Y%m%d").date()


def stored_usage(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """The usage of a range of stored days, as ``device_usage`` gives it; only their folders are read."""
    schema = "idfa string, ip string, day int, videos bigint, mask int, d string"
    rows = spark.read.schema(schema).parquet(f"{path}/usage").where(day_between(start, end))
    return rows.groupBy("idfa", "ip", "day").agg(F.sum("videos").alias("videos"), F.bit_or("mask").alias("mask"))


def _by_key(usage: DataFrame, key: str, partner: str) -> DataFrame:
    """Per key: partners, most partners in a day, videos, most videos in a day, days, hour mask."""
    sets = usage.groupingSets([[key, partner], [key, "day"]], key, partner, "day").agg(
        F.grouping(partner).alias("is_day"),
        F.count("*").alias("partners"),
        F.sum("videos").alias("videos"),
        F.bit_or("mask").alias("mask"),
    )
    is_day = F.col("is_day") == 1

    def of_day(name: str) -> Column:
        return F.when(is_day, F.col(name))

    return sets.groupBy(key).agg(
        F.count_if(~is_day).alias("partners"),
        F.max(of_day("partners")).alias("partners_max"),
        F.sum(of_day("videos")).alias("vcount"),
        F.max(of_day("videos")).alias("vcountmax"),
        F.count_if(is_day).alias("vdays"),
        F.bit_or(of_day("mask")).alias("mask"),
    )


def device_profile(usage: DataFrame) -> DataFrame:
    """Nine features per device; ``hours`` is the number of distinct hours of the day."""
    videos, ips, days = F.col("vcount"), F.col("partners"), F.col("vdays")
    return _by_key(usage, "idfa", "ip").select(
        "idfa",
        ips.alias("ipcount"),
        "vcount",
        F.col("partners_max").alias("ipmax"),
        "vcountmax",
        "vdays",
        ratio2(videos, days).alias("vdaymean"),
        ratio2(videos, ips).alias("vipmean"),
        F.bit_count("mask").cast("bigint").alias("hours"),
        ratio2(ips, days).alias("ipdaymean"),
    )


def ip_profile(usage: DataFrame) -> DataFrame:
    """Six features per IP; ``hour_mask`` has bit ``h`` set for every hour ``h`` seen."""
    return _by_key(usage, "ip", "idfa").select(
        "ip",
        F.col("partners").alias("idfacount"),
        "vcount",
        "vcountmax",
        "vdays",
        ratio2(F.col("vcount"), F.col("vdays")).alias("vdaymean"),
        F.col("mask").alias("hour_mask"),
    )
