"""Labels derived from raw codes and texts."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Tag ids of the three placement letters.
PLACEMENT_TAGS = {
    "a": ["25", "26", "27", "28", "29", "30", "55", "79", "82", "58", "87"],
    "k": ["31", "32", "34", "35", "37", "38", "54", "78", "81", "57", "86"],
    "z": ["33", "19", "36", "20", "39", "21", "56", "80", "83", "59", "88"],
}

# Channels counted as television; every other channel is user content.
TV_CHANNELS = [
    "9003", "c", "22", "10009", "9004", "d", "30", "10016", "9021", "v", "31", "10017",
    "9018", "q", "9017", "r", "9001", "a",
]

# Display names of the platforms.
PLATFORM_NAMES = {
    "tencent": "腾讯视频",
    "iqiyi": "爱奇艺",
    "letv": "乐视",
    "youku": "优酷视频",
    "baidu_bc": "百度百川",
}

# The device codes of the daily report and of the on-demand report differ.
DAILY_DEVICES = {0: "Mobile", 1: "PC"}
ON_DEMAND_DEVICES = {0: "Mobile", 1: "Tablet"}

APP_MARK = "客户端"


def _first_hit(text: Column, rules: list[tuple[list[str], str]], default: str) -> Column:
    label = F.lit(default)
    for needles, name in reversed(rules):
        hit = F.lit(False)
        for needle in needles:
            hit = hit | text.contains(needle)
        label = F.when(hit, F.lit(name)).otherwise(label)
    return label


#: Signs of the systems in any letter case, first hit first.
SYSTEMS = [(["windows"], "Windows"), (["mac"], "Mac"), (["linux"], "Linux"), (["ios"], "IOS"), (["android"], "Android")]


def os_class(os: Column) -> Column:
    """System of a traffic report row, any letter case; NULL gives ``Other``."""
    return _first_hit(F.lower(os), SYSTEMS, "Other")


def os_class_request(os: Column) -> Column:
    """System of a reach request: case-sensitive, Linux before Mac, Apple device names known."""
    return _first_hit(
        os,
        [(["windows"], "Windows"), (["linux"], "Linux"), (["mac"], "Mac"),
         (["iphone", "ipad", "ios"], "IOS"), (["android"], "Android")],
        "Other",
    )


def os_class_pv(os: Column) -> Column:
    """System of a keyword page view: IOS, Android or ``-``."""
    return _first_hit(F.lower(os), [(["ios"], "IOS"), (["android"], "Android")], "-")


def device_daily(code: Column) -> Column:
    return _code_label(code, DAILY_DEVICES, "Tablet")


def device_on_demand(code: Column) -> Column:
    return _code_label(code, ON_DEMAND_DEVICES, "PC")


def _code_label(code: Column, names: dict[int, str], default: str) -> Column:
    label = F.lit(default)
    for value, name in names.items():
        label = F.when(code == value, F.lit(name)).otherwise(label)
    return label


def device_from_app(name: Column) -> Column:
    """Mobile when the site or app name carries the client mark, PC for other names."""
    return (
        F.when(F.coalesce(name, F.lit("")) == "", "other")
        .when(name.contains(APP_MARK), "Mobile")
        .otherwise("PC")
    )


def size_label(width: Column, height: Column) -> Column:
    """``WxH``; NULL when a side is NULL."""
    return F.concat(width.cast("string"), F.lit("x"), height.cast("string"))


def placement_label(
    tag: Column,
    channel: Column,
    tags: dict[str, list[str]] = PLACEMENT_TAGS,
    tv_channels: list[str] = TV_CHANNELS,
) -> Column:
    """Letter of the tag followed by ``tv`` or ``ugc``; a tag without a letter stays as it is."""
    tail = F.when(channel.isin(tv_channels), "tv").otherwise("ugc")
    label = tag
    for letter, members in reversed(list(tags.items())):
        label = F.when(tag.isin(members), F.concat(F.lit(letter), tail)).otherwise(label)
    return label


def platform_name(platform: Column, names: dict[str, str] = PLATFORM_NAMES) -> Column:
    label = F.lit(None).cast("string")
    for code, name in names.items():
        label = F.when(platform == code, F.lit(name)).otherwise(label)
    return label


def source_alias(source: Column) -> Column:
    """Platform of a source: ``bc`` is reported as ``baidu_bc``."""
    return F.when(source == "bc", "baidu_bc").otherwise(source)


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``checkos(os)`` callable from SQL; the body is SQL, so it is inlined by Catalyst."""
    cases = " ".join(f"WHEN contains(lower(os), '{sign}') THEN '{name}'" for signs, name in SYSTEMS for sign in signs)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION checkos(os STRING) RETURNS STRING RETURN CASE {cases} ELSE 'Other' END")
