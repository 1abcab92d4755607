"""The test tables seen as the tables the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.schemas import PRICE

PACK_WORDS = ["Brand#1", "Brand#3", "PROMO", "SMALL", "red", "blue", "widget", "gear"]
FEATURES = [("subchannel", "sc"), ("creative_id", "cr")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream of its files; a glob, because the path may be a single file."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{{name}}}.parquet")


def _compact_day(ts: str) -> Column:
    return F.replace(F.substring(F.col(ts).cast("string"), 1, 10), F.lit("-"), F.lit(""))


def _text(value: Column) -> Column:
    return value.cast("string")


def _pick(number: Column, labels: list[str], default: str | None = None) -> Column:
    label = F.lit(default)
    for at, name in enumerate(labels):
        label = F.when(number == at, F.lit(name)).otherwise(label)
    return label


def _with_k(events: DataFrame) -> DataFrame:
    """Events with the number in ``props``; a generator, so that filters do not parse it again."""
    return events.select("*", F.inline(F.array(F.from_json("props", "k bigint"))))


def tracking(events: DataFrame) -> DataFrame:
    """Tracking events; works on the stream of the table too."""
    user, k = F.col("user_id"), F.col("k")
    event = (
        F.when(F.col("event_type") == "view", 1)
        .when(F.col("event_type") == "click", 2)
        .when(F.col("event_type") == "purchase", 3)
        .when(F.col("event_type") == "signup", 6)
        .when(k % 3 == 0, 4)
        .when(k % 3 == 1, 5)
        .otherwise(7)
    )
    return _with_k(events).select(
        "event_id",
        "ts",
        _compact_day("ts").alias("d"),
        F.hour("ts").alias("h"),
        _text(user % 10).alias("client_id"),
        (user % 7).cast("int").alias("group_id"),
        (user % 50).cast("int").alias("ad_id"),
        (user % 13).cast("int").alias("creative_id"),
        _text(user % 20).alias("tag_id"),
        _text(k % 8).alias("channel_id"),
        _text(user % 31).alias("city"),
        _text(k % 3).alias("placement_id"),
        _pick(k % 6, ["youku", "iqiyi", "letv", "tencent", "baidu_bc"], "bc").alias("source"),
        event.alias("event"),
        F.col("value").cast(PRICE).alias("price"),
    )


def log_stamp() -> Column:
    """``yyyyMMddHH`` of a tracking row."""
    return F.concat("d", F.lpad(F.col("h").cast("string"), 2, "0"))


def bids(events: DataFrame) -> DataFrame:
    user, k = F.col("user_id"), F.col("k")
    large = F.col("event_id") % 4 == 3
    return _with_k(events).select(
        F.concat(F.when(user % 5 == 0, "imei").otherwise("idfa-"), _text(user)).alias("user_id"),
        F.concat(F.lit("10.0.0."), _text(k % 20)).alias("ip"),
        F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).alias("time_i"),
        _compact_day("ts").alias("d"),
        F.hour("ts").alias("h"),
        F.when(large, 1280).otherwise(640).alias("width"),
        F.when(large, 720).otherwise(480).alias("height"),
        (user % 3).cast("int").alias("device_type"),
        _pick(k % 7, ["Windows NT", "Mac OS X", "Linux x86", "iOS 9", "Android 6", "Symbian"]).alias("os"),
        F.when(k % 8 == 7, "").otherwise(F.concat(F.lit("c"), _text(k % 8))).alias("channel"),
        _text(k % 90).alias("tagid"),
        F.concat(F.lit("p"), _text(k % 90)).alias("placementid"),
        _pick(user % 3, ["app客户端", "web"]).alias("site_or_app_name"),
        F.array(
            F.col("event_type"), F.concat(F.lit("k"), _text(k % 10)), F.concat(F.lit("u"), _text(user % 6))
        ).alias("keywords"),
    )


def deliveries(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    rows = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        F.col("l_orderkey").alias("click_uuid"),
        _compact_day("l_shipdate").alias("d"),
        (F.col("l_orderkey") % 24).cast("int").alias("h"),
        F.when(F.col("l_linenumber") == 1, 0).otherwise(1).alias("request_time"),
        _text(F.col("l_suppkey") % 20).alias("ad_id"),
        F.col("l_linestatus").alias("source"),
        F.lit(1).alias("impression"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("click"),
        F.col("l_quantity").cast("int").alias("bidprice"),
        F.col("l_extendedprice").cast(PRICE).alias("price"),
        F.col("l_returnflag").alias("subchannel"),
        F.col("p_brand").alias("creative_id"),
        F.array(
            "p_type", "p_brand", F.split_part("p_name", F.lit(" "), F.lit(1)),
            F.split_part("p_name", F.lit(" "), F.lit(2)),
        ).alias("keywords"),
    )


def delivery_bids(rows: DataFrame) -> DataFrame:
    """Deliveries as keyword bid requests."""
    return rows.select(
        F.col("subchannel").alias("channel"),
        F.when(F.col("subchannel") == "R", "iOS 9").when(F.col("subchannel") == "A", "Android 6")
        .otherwise("Symbian").alias("os"),
        "keywords",
    )


def conversions(orders: DataFrame) -> DataFrame:
    return orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("format_uuid"))


def fixed_pack(spark: SparkSession, words: list[str] = PACK_WORDS) -> DataFrame:
    """A pack of known words; built in the plan, so its size is known to the optimizer."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, words))).alias("keyword"))


def ad_pack(part: DataFrame) -> DataFrame:
    """Every brand, type and name word belongs to four ads."""
    words = part.select(
        F.explode(F.array(
            "p_type", "p_brand", F.split_part("p_name", F.lit(" "), F.lit(1)),
            F.split_part("p_name", F.lit(" "), F.lit(2)),
        )).alias("keyword")
    ).distinct()
    seed = F.length("keyword") * 7 + F.ascii(F.right("keyword", F.lit(1)))
    shifts = F.explode(F.array(*[F.lit(n) for n in (0, 3, 7, 11)]))
    return words.select("keyword", shifts.alias("shift")).select(
        _text((seed + F.col("shift")) % 20).alias("ad_id"), "keyword"
    )
