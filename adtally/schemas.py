"""Column names and types of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 4)

# Field names of the tracking log's JSON body. All are strings, all are optional.
LOG_JSON_FIELDS = [
    "hqClientId", "hqCliendId", "hqGroupId", "hqAdId", "hqCreativeId", "hqRefer", "hqTime",
    "hqEvent", "hqURL", "hqPrice", "hquid", "hqCity", "tagId", "channelId", "hqSource",
    "cookie", "id", "did", "impid", "plmtid",
]

CORRUPT = "_corrupt_record"

LOG_JSON = T.StructType(
    [T.StructField(name, T.StringType()) for name in [*LOG_JSON_FIELDS, CORRUPT]]
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

TRACKING = _struct(
    client_id=_S, group_id=_I, ad_id=_I, creative_id=_I, refer=_S, time=_I, event=_I, url=_S,
    price=PRICE, source=_S, user_id=_S, city=_S, tag_id=_S, channel_id=_S, cookie=_S, id=_S,
    uuid=_S, did=_S, imp_id=_S, placement_id=_S, d=_S, h=_I,
)

BID_REQUEST = _struct(
    user_id=_S, ip=_S, time_i=_L, width=_I, height=_I, device_type=_I, os=_S, channel=_S,
    tagid=_S, placementid=_S, site_or_app_name=_S, keywords=T.ArrayType(_S), d=_S, h=_I,
)

DELIVERIES = _struct(
    click_uuid=_S, ad_id=_S, source=_S, keywords=T.ArrayType(_S), impression=_I, click=_I,
    bidprice=_I, price=PRICE, request_time=_L, d=_S, h=_I,
)

STREAM_COUNTS = _struct(
    client_id=_S, group_id=_I, ad_id=_I, creative_id=_I, tag_id=_S, channel_id=_S, placement_id=_S,
    platform=_S, impression=_L, click=_L, download=_L, follow=_L, install=_L, active=_L,
    billed=T.DecimalType(28, 4), d=_S, h=_I, stream_id=_S, batch_id=_L,
)

WINDOW_COUNTS = _struct(
    window_start=T.TimestampType(), window_end=T.TimestampType(), word=_S, n=_L, stream_id=_S, batch_id=_L
)

FOLDED_COUNTS = T.StructType([*(f for f in STREAM_COUNTS if f.name != "batch_id"), T.StructField("upto", _L)])

FEATURE_COLUMNS = _struct(column=_S, short=_S)
FEATURE_INDEX = _struct(feature=_S, idx=_L)

REPORT_REQUEST = T.StructType([
    T.StructField("id", _L),
    T.StructField("platform", _S),
    T.StructField("start_time", _S),
    T.StructField("end_time", _S),
    T.StructField("type", _S),
    T.StructField("filters", _struct(
        tagid=T.ArrayType(_S), placementid=T.ArrayType(_S), channel=T.ArrayType(_S),
        device=T.ArrayType(_S), os=T.ArrayType(_S), size=T.ArrayType(_S),
    )),
    T.StructField("report", _struct(columns=_S)),
])

# Column names of existing Hive tables and the names used here.
LEGACY_COLUMNS = {
    "hqclientid": "client_id",
    "hqgroupid": "group_id",
    "hqadid": "ad_id",
    "hqcreativeid": "creative_id",
    "hqrefer": "refer",
    "hqtime": "time",
    "hqevent": "event",
    "hqurl": "url",
    "hqprice": "price",
    "hqsource": "source",
    "hquid": "user_id",
    "hqcity": "city",
    "tagid": "tag_id",
    "channelid": "channel_id",
    "impid": "imp_id",
    "hqplacementid": "placement_id",
}
