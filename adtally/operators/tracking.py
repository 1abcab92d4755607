"""Cleaning of raw tracking log lines.

A line is ``stamp TAB ad TAB json`` with a ``yyyyMMddHH…`` stamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions.dates import stamp_day, stamp_hour
from adtally.functions.labels import source_alias
from adtally.schemas import CORRUPT, LOG_JSON, LOG_JSON_FIELDS, PRICE, TRACKING

# Sources whose events are reported.
SOURCES = ["letv", "baidu_bc", "youku", "tencent", "iqiyi"]

REJECT = "reject"


def parse_lines(lines: DataFrame, exact_fields: bool = False) -> DataFrame:
    """Lines with their stamp, the JSON fields as columns and a ``reject`` flag.

    A line is rejected when it has fewer than three tab fields (with ``exact_fields`` also when
    it has more) or when the third is not a JSON object. Empty fields at the end do not count.

    ``inline`` unpacks the parsed struct because, unlike a projection, a generator is not
    crossed by later filters: each line is parsed once, however many columns are tested.
    """
    parts = F.split(F.rtrim(F.col("value"), F.lit("\t")), "\t")
    size = F.size(parts)
    enough = (size == 3) if exact_fields else (size >= 3)
    empty = F.struct(*[
        F.lit("" if name == CORRUPT else None).cast("string").alias(name)
        for name in LOG_JSON.names
    ])
    body = F.when(enough, F.get(parts, F.lit(2)))
    parsed = F.coalesce(F.from_json(body, LOG_JSON, {"columnNameOfCorruptRecord": CORRUPT}), empty)
    return lines.select(
        "value", F.substring_index("value", "\t", 1).alias("stamp"), F.inline(F.array(parsed))
    ).withColumn(REJECT, F.col(CORRUPT).isNotNull()).drop(CORRUPT)


def rejected_lines(parsed: DataFrame) -> DataFrame:
    """The raw text of rejected lines."""
    return parsed.where(REJECT).select("value")


def normalize(
    parsed: DataFrame,
    sources: list[str] | None = SOURCES,
    alias_first: bool = False,
    with_uuid: bool = True,
    day: str | None = None,
    hour: int | None = None,
) -> DataFrame:
    """Typed tracking rows of the wanted sources, partition keys included.

    ``day`` and ``hour`` override the keys taken from the line's stamp. ``alias_first`` lets the
    alias of a source pass the source list. Every row gets a random ``uuid`` unless
    ``with_uuid`` is off.
    """
    rows = parsed.where(~F.col(REJECT))
    source = F.col("hqSource")
    if alias_first:
        source = source_alias(source)
    if sources is not None:
        rows = rows.where(source.isin(sources))

    def text(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default))

    def number(name: str) -> Column:
        return text(name, "0").try_cast("int")

    return rows.select(
        F.coalesce("hqClientId", "hqCliendId").alias("client_id"),
        number("hqGroupId").alias("group_id"),
        number("hqAdId").alias("ad_id"),
        number("hqCreativeId").alias("creative_id"),
        F.regexp_replace(text("hqRefer", ""), r"\s+", "").alias("refer"),
        F.col("hqTime").try_cast("int").alias("time"),
        F.col("hqEvent").try_cast("int").alias("event"),
        text("hqURL", "-").alias("url"),
        F.coalesce(F.nullif(F.col("hqPrice"), F.lit("")), F.lit("0")).try_cast(PRICE).alias("price"),
        source.alias("source"),
        F.col("hquid").alias("user_id"),
        text("hqCity", "-").alias("city"),
        text("tagId", "-").alias("tag_id"),
        text("channelId", "-").alias("channel_id"),
        F.col("cookie"),
        F.col("id"),
        (F.expr("uuid()") if with_uuid else F.lit(None).cast("string")).alias("uuid"),
        F.col("did"),
        F.coalesce("impid", "id").alias("imp_id"),
        text("plmtid", "").alias("placement_id"),
        (F.lit(day) if day else stamp_day(F.col("stamp"))).alias("d"),
        (F.lit(hour) if hour is not None else stamp_hour(F.col("stamp"))).alias("h"),
    )


def to_log_lines(tracking: DataFrame, stamp: Column) -> DataFrame:
    """Tracking rows as raw lines again; NULL columns are left out of the JSON."""
    names = dict(zip(LOG_JSON_FIELDS, [
        "client_id", None, "group_id", "ad_id", "creative_id", "refer", "time", "event", "url",
        "price", "user_id", "city", "tag_id", "channel_id", "source", "cookie", "id", "did",
        "imp_id", "placement_id",
    ]))
    fields = [
        F.col(column).cast("string").alias(name)
        for name, column in names.items()
        if column in tracking.columns
    ]
    return tracking.select(F.concat_ws("\t", stamp, F.lit("-"), F.to_json(F.struct(*fields))).alias("value"))

