import json

import pytest
from pyspark.sql import functions as F

from adtally.operators import keywords, traffic
from adtally.schemas import BID_REQUEST
from adtally.sinks.exports import json_message, json_rows
from adtally.sources.requests import ReachSpec, ReportSpec, parse_requests, split_columns


def bid(**fields):
    base = {name: None for name in BID_REQUEST.names} | {"d": "20160616", "h": 1, "width": 640, "height": 480}
    return base | fields


def bids(spark, *rows):
    return spark.createDataFrame([tuple(bid(**r)[n] for n in BID_REQUEST.names) for r in rows], BID_REQUEST)


def request(**changes):
    base = {
        "id": 3, "platform": "youku", "start_time": "20160616", "end_time": "20160616", "type": "t",
        "filters": {"device": ["Mobile", "Tablet"], "placementid": ["atv"]},
        "report": {"columns": "day,platform,placementid,channel"},
    }
    return json.dumps(base | changes)


def test_request_of_the_clause_case(spark):
    spec = ReportSpec.from_json(request())
    assert spec.filters == {"device": (0, 1), "placementid": ("atv",)}
    assert traffic.request_columns(spec) == ["day", "platform", "placementid", "channel"]
    rows = bids(
        spark,
        dict(device_type=0, placementid="atv", channel="x"), dict(device_type=1, placementid="atv", channel="x"),
        dict(device_type=2, placementid="atv", channel="x"), dict(device_type=0, placementid="btv", channel="x"),
        dict(device_type=0, placementid="atv", channel="x", d="20160617"), dict(device_type=0, placementid="atv", channel="y"),
    )
    report = traffic.traffic_report(rows, spec)
    assert report.columns == ["day", "platform", "placementid", "channel", "count"]
    assert sorted(map(tuple, report.collect())) == [("20160616", "youku", "atv", "x", 2), ("20160616", "youku", "atv", "y", 1)]
    shown = traffic.display_rows(report).where("channel = 'y'").first()
    assert tuple(shown) == ("2016-06-16", "优酷视频", "atv", "y", 1)


def test_other_platform_has_few_dimensions_and_no_filters(spark):
    spec = ReportSpec.from_json(request(platform="iqiyi", report={"columns": "device,day,hour"}))
    rows = bids(spark, dict(device_type=2), dict(device_type=0), dict(h=2))
    assert sorted(map(tuple, traffic.traffic_report(rows, spec).collect())) == [("20160616", 1, 2), ("20160616", 2, 1)]


def test_unknown_platform():
    with pytest.raises(ValueError):
        traffic.traffic_report(None, ReportSpec(platform="none", start="", end=""))


def test_platform_only_report_of_nothing_is_empty(spark):
    spec = ReportSpec.from_json(request(report={"columns": "platform"}))
    assert traffic.traffic_report(bids(spark, dict(d="20200101")), spec).collect() == []


def test_unknown_device_matches_nothing(spark):
    rows = bids(spark, dict(device_type=0), dict(device_type=1))
    spec = ReportSpec.from_json(request(filters={"device": ["Watch", "Mobile"]}, report={"columns": "device"}))
    assert [tuple(r) for r in traffic.traffic_report(rows, spec).collect()] == [("Mobile", 1)]
    spec = ReportSpec.from_json(request(filters={"device": ["Watch"]}, report={"columns": "device"}))
    assert traffic.traffic_report(rows, spec).collect() == []


def test_split_columns():
    assert split_columns(" day, hour,day,,x ") == ("day", "hour", "x")


def test_request_text_cannot_reach_the_plan_as_code(spark):
    spec = ReportSpec.from_json(request(filters={"channel": ["x') or ('1'='1"]}))
    assert traffic.traffic_report(bids(spark, dict(channel="x")), spec).count() == 0


def test_request_table(spark):
    rows = parse_requests(spark.createDataFrame([(request(),)], "value string")).first()
    assert (rows.id, rows.platform, rows.filters.device, rows.report.columns) == (
        3, "youku", ["Mobile", "Tablet"], "day,platform,placementid,channel")


def test_daily(spark):
    rows = bids(spark, dict(device_type=1, os="iOS 9", channel="c"), dict(device_type=1, os="IOS", channel="c"), dict(device_type=2, tagid="4"))
    got = {(r.placement, r.channel, r.device, r.system, r["count"], r.day, r.platform) for r in traffic.daily_traffic(rows).collect()}
    assert got == {("-", "c", "PC", "IOS", 2, "2016-06-16", "youku"), ("4", None, "Tablet", "Other", 1, "2016-06-16", "youku")}


REACH = [
    dict(channel="c1", h=1, site_or_app_name="app客户端", os="ios", tagid="25", keywords=["a"]),
    dict(channel="c1", h=1, site_or_app_name="web", os="linux", tagid="7", keywords=["x", "b"]),
    dict(channel="c1", h=2, site_or_app_name="web", os="ios", tagid="7", keywords=["x"]),
    dict(channel="", h=2, site_or_app_name="web", os="ios", tagid="7", keywords=["a"]),
    dict(channel=None, h=2, site_or_app_name="web", os="ios", tagid="7", keywords=["a"]),
    dict(channel="c2", h=2, site_or_app_name=None, os=None, tagid="7", keywords=["a", "b"]),
    dict(channel="c2", h=2, site_or_app_name=None, os="", tagid="7", keywords=None),
]


def test_reach(spark):
    pack = spark.createDataFrame([("a",), ("b",), ("a",)], "keyword string")

    def counts(**lists):
        spec = ReachSpec.from_json(json.dumps({"id": 1, **lists}))
        return sorted(map(tuple, keywords.reach(traffic.reach_rows(bids(spark, *REACH), spec), pack, "youku").collect()))

    assert counts() == [("youku", "c1", 1, 2), ("youku", "c2", 2, 1)]
    assert counts(device=["Mobile"]) == [("youku", "c1", 1, 1)]
    assert counts(system=["Other"]) == [("youku", "c2", 2, 1)]
    assert counts(placementid=["augc"], size=["640x480"], channel=["c1"]) == [("youku", "c1", 1, 1)]
    assert counts(size=["1x1"]) == []


def document(fragments):
    return "".join(r.fragment for r in sorted(fragments.collect(), key=lambda r: r.at))


def test_long_json_message(spark):
    rows = spark.range(120_000).selectExpr("cast(id as string) as channel", "id as n")
    data = json.loads(document(json_message(rows, 3)))["data"]
    assert len(data) == 120_000 and [r["channel"] for r in data[:3]] == ["0", "1", "10"]


def test_json_message(spark):
    rows = spark.createDataFrame([("youku", "c2", 1, 3), ("youku", "c1", 2, 4)], "platform string, channel string, hour int, count long")
    assert document(json_message(rows, 7)) == '{"id":7,"data":[{"platform":"youku","channel":"c1","hour":2,"count":4},{"platform":"youku","channel":"c2","hour":1,"count":3}]}'
    assert document(json_message(rows.where("hour > 5"), 7)) == '{"id":7,"data":[]}'
    assert document(json_message(rows.union(rows), 7)).count('"c1"') == 2
    assert json.loads(json_rows(rows).where(F.col("json").contains("c1")).first().json)["count"] == 4
