"""Hourly performance reports over tracking rows.

A report has two steps: ``rollup`` gives additive counters per key (the billed amount stays a
decimal, so rollups can be merged and rolled up further without rounding), ``finish`` turns them
into report rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions.labels import source_alias
from adtally.functions.numbers import ratio2
from adtally.schemas import PRICE

# Event codes of the counters, of a billed view and of a billed action.
EVENTS = {"impression": 1, "click": 2, "download": 4, "follow": 5, "install": 6, "active": 7}
VIEW_EVENT = 1
BILLED_EVENT = 3

SLICE = ["platform", "d", "h"]
GRAIN = {
    "all_report": ["client_id", "group_id", "ad_id", "creative_id", "tag_id", "channel_id",
                   "placement_id", *SLICE],
    "report": ["client_id", "group_id", "ad_id", "creative_id", "tag_id", "placement_id", *SLICE],
    "channel_report": ["client_id", "group_id", "ad_id", "channel_id", *SLICE],
    "geo_report": ["client_id", "group_id", "ad_id", "city", *SLICE],
}
FINEST = [*GRAIN["all_report"][:-3], "city", *SLICE]

# Columns the report database names differently.
DATABASE_NAMES = {"placement_id": "placementid", "city": "city_code"}

COUNTERS = list(EVENTS)
MEASURES = [*COUNTERS, "billed"]


def batch_billing() -> Column:
    """Sources that sell views are billed on the view, all others on the billed action."""
    sells_views = F.coalesce(F.col("source").isin("baidu_bc", "tencent"), F.lit(False))
    return F.col("event") == F.when(sells_views, VIEW_EVENT).otherwise(BILLED_EVENT)


def stream_billing() -> Column:
    """The stream bills the view of ``bc`` and ``tencent`` and every billed action."""
    sells_views = F.coalesce(F.col("source").isin("bc", "tencent"), F.lit(False))
    return (sells_views & (F.col("event") == VIEW_EVENT)) | (F.col("event") == BILLED_EVENT)


def counters(billing: Callable[[], Column] = batch_billing) -> list[Column]:
    """Aggregates of one pass over tracking rows."""
    counts = [F.count_if(F.col("event") == code).alias(name) for name, code in EVENTS.items()]
    price = F.coalesce(F.col("price"), F.lit(0).cast(PRICE))
    billed = F.sum(F.when(billing(), price).otherwise(F.lit(0).cast(PRICE)))
    return [*counts, billed.alias("billed")]


def rollup(
    tracking: DataFrame,
    keys: Sequence[str],
    billing: Callable[[], Column] = batch_billing,
) -> DataFrame:
    """Counters per key; ``platform`` is the alias-free source."""
    rows = tracking.withColumn("platform", source_alias(F.col("source")))
    return rows.groupBy(*keys).agg(*counters(billing))


def reroll(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counters per coarser key."""
    return counts.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in MEASURES])


def finish(counts: DataFrame, positive_only: bool = True) -> DataFrame:
    """Report rows: cost in thousandths, rows without impressions or cost dropped."""
    cost = F.col("billed").cast("double") / 1000
    rows = counts.withColumn("cost", cost).drop("billed")
    return rows.where("impression > 0 and cost > 0") if positive_only else rows


def report(
    tracking: DataFrame, name: str, billing: Callable[[], Column] = batch_billing
) -> DataFrame:
    """One of the four reports straight from tracking rows."""
    return finish(rollup(tracking, GRAIN[name], billing))


def reports_from(finest: DataFrame) -> dict[str, DataFrame]:
    """All four reports from one rollup at the ``FINEST`` grain."""
    return {name: finish(reroll(finest, keys)) for name, keys in GRAIN.items()}


def database_rows(report: DataFrame) -> DataFrame:
    """Report rows with the columns of the report database: a date, an hour, its own names."""
    day = F.to_date("d", "yyyyMMdd")
    rows = report.withColumn("day", day).withColumnRenamed("h", "hour").drop("d")
    return rows.withColumnsRenamed(DATABASE_NAMES)


def report_rows(stored: DataFrame) -> DataFrame:
    """Rows of the report database as report rows; absent texts are empty."""
    texts = [name for name in ("platform", "tag_id", "channel_id", "placementid") if name in stored.columns]
    filled = stored.fillna("", subset=texts).withColumnsRenamed({v: k for k, v in DATABASE_NAMES.items()})
    day = F.date_format("day", "yyyyMMdd")
    return filled.withColumn("d", day).withColumnRenamed("hour", "h").drop("day")


def time_bounds(rows: DataFrame) -> DataFrame:
    """First and last (day, hour) of a batch, one row."""
    moment = F.struct("d", "h")
    bounds = rows.agg(F.min(moment).alias("first"), F.max(moment).alias("last"))
    return bounds.select(
        F.col("first.d").alias("first_d"), F.col("first.h").alias("first_h"),
        F.col("last.d").alias("last_d"), F.col("last.h").alias("last_h"),
    )


def keyword_kpis(
    report: DataFrame, start: str | None = None, end: str | None = None,
    ad_id: str | None = None, platform: str | None = None,
) -> DataFrame:
    """Totals per keyword with click rate and cost per mille, most impressions first.

    Days ``start`` to ``end`` (inclusive), one ad and one platform, where they are given.
    """
    if start is not None:
        report = report.where(F.col("d") >= start)
    if end is not None:
        report = report.where(F.col("d") <= end)
    for name, value in (("ad_id", ad_id), ("platform", platform)):
        if value is not None:
            report = report.where(F.col(name) == value)
    totals = report.groupBy("keyword").agg(
        *[F.sum(name).alias(name) for name in ("impression", "click", "cost")]
    )
    shown = F.col("impression")
    return totals.select(
        "keyword", "impression", "click",
        ratio2(F.col("cost"), F.lit(100)).alias("cost"),
        ratio2(F.col("click") * 100, shown).alias("ctr"),
        ratio2(F.col("cost") * 10, shown).alias("cpm"),
    ).orderBy(F.desc("impression"), "keyword")
