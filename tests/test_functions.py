import datetime as dt

import pytest
from pyspark.sql import functions as F

from adtally.functions import dates, labels, numbers


def values(spark, data, schema, column):
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


def texts(spark, function, inputs):
    return values(spark, [(i,) for i in inputs], "x string", function(F.col("x")))


def test_os_class(spark):
    inputs = ["Windows NT", "Mac OS X", "Linux; Android", "iOS 9", "Android 6", "x", "", None]
    want = ["Windows", "Mac", "Linux", "IOS", "Android", "Other", "Other", "Other"]
    assert texts(spark, labels.os_class, inputs) == want
    labels.register_sql_functions(spark)
    frame = spark.createDataFrame([(i,) for i in inputs], "x string")
    assert [r[0] for r in frame.selectExpr("checkos(x)").collect()] == want


def test_os_class_request_is_case_sensitive(spark):
    inputs = ["windows", "Windows", "mac linux", "mac", "iphone", "ipad", "ios", "android", ""]
    want = ["Windows", "Other", "Linux", "Mac", "IOS", "IOS", "IOS", "Android", "Other"]
    assert texts(spark, labels.os_class_request, inputs) == want


def test_os_class_pv(spark):
    assert texts(spark, labels.os_class_pv, ["iOS 9", "ANDROID", "Windows", None]) == ["IOS", "Android", "-", "-"]


def test_device_maps_differ(spark):
    codes = [(0,), (1,), (2,), (None,)]
    assert values(spark, codes, "x int", labels.device_daily(F.col("x"))) == ["Mobile", "PC", "Tablet", "Tablet"]
    assert values(spark, codes, "x int", labels.device_on_demand(F.col("x"))) == ["Mobile", "Tablet", "PC", "PC"]


def test_device_from_app(spark):
    assert texts(spark, labels.device_from_app, ["app客户端", "web", "", None]) == ["Mobile", "PC", "other", "other"]


def test_placement_label(spark):
    rows = [("25", "9003"), ("25", "x"), ("86", "a"), ("33", None), ("99", "9003"), (None, "c")]
    got = values(spark, rows, "t string, c string", labels.placement_label(F.col("t"), F.col("c")))
    assert got == ["atv", "augc", "ktv", "zugc", "99", None]


def test_platform_name_and_alias(spark):
    assert texts(spark, labels.platform_name, ["youku", "other"]) == ["优酷视频", None]
    assert texts(spark, labels.source_alias, ["bc", "youku", None]) == ["baidu_bc", "youku", None]


@pytest.mark.parametrize("a,b,want", [(1, 8, 0.13), (201, 200, 1.01), (7, 1, 7.0), (0, 3, 0.0), (2, 3, 0.67), (1, 0, None)])
def test_ratio2(spark, a, b, want):
    assert values(spark, [(a, b)], "a long, b long", numbers.ratio2(F.col("a"), F.col("b"))) == [want]


def test_price_or_zero(spark):
    assert [float(v) for v in texts(spark, numbers.price_or_zero, ["5", "", "x", None, "1.25"])] == [5, 0, 0, 0, 1.25]


def test_log_density(spark):
    row = [(2.0, 1.0, 4.0), (1.0, 1.0, 0.0)]
    got = values(spark, row, "x double, m double, v double", numbers.log_density(F.col("x"), F.col("m"), F.col("v")))
    assert got[0] == pytest.approx(-0.125 - 1.612085713764618)
    assert got[1] is None


def test_epoch_day_and_hour_ignore_the_session_zone(spark):
    rows = [(0,), (86_399,), (1_704_067_200 + 3_600 * 5,)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Asia/Shanghai", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert values(spark, rows, "s long", dates.epoch_day(F.col("s"))) == ["19700101", "19700101", "20240101"]
            assert values(spark, rows, "s long", dates.epoch_hour(F.col("s"))) == [0, 23, 5]
        assert values(spark, rows, "s long", dates.epoch_hour(F.col("s"), 8 * 3600)) == [8, 7, 13]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_stamps(spark):
    assert texts(spark, dates.stamp_day, ["2024010207"]) == ["20240102"]
    assert texts(spark, dates.stamp_hour, ["2024010207", "20240102"]) == [7, None]
    assert texts(spark, dates.iso_day, ["20240102"]) == ["2024-01-02"]
    now = dt.datetime(2024, 3, 1, 0, 10)
    assert dates.yesterday(now) == "20240229"
    assert dates.previous_hour(now) == ("20240229", 23)
