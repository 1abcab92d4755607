import json
import os
import re

import pytest

from adtally.operators import reports
from adtally.plans import adapters as a
from adtally.plans import jobs
from adtally.schemas import BID_REQUEST
from adtally.session import shared_root
from adtally.sinks.files import replace_partitions
from adtally.sources.tables import read_slice

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Tables of the test data in the layout the jobs expect."""
    root = str(tmp_path_factory.mktemp("tables"))
    bids = a.bids(a.table(spark, SF, "events"))
    replace_partitions(bids.select(*BID_REQUEST.names), f"{root}/bid_request", ["d"])
    deliveries = a.deliveries(a.table(spark, SF, "lineitem"), a.table(spark, SF, "part"))
    legacy = deliveries.withColumnsRenamed({"ad_id": "hqadid", "source": "hqsource", "creative_id": "hqcreativeid"})
    legacy = legacy.where("d between '19970101' and '19970110'")
    replace_partitions(legacy, f"{root}/deliveries")
    converted = a.conversions(a.table(spark, SF, "orders")).selectExpr("format_uuid", "'19970105' as d")
    replace_partitions(converted, f"{root}/conversions", ["d"])
    return root


def line(**fields):
    return "2024010203\tad\t" + json.dumps({"hqClientId": "1", "hqSource": "tencent", "hqEvent": "1", "hqPrice": "5"} | fields)


def test_hour(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "log").write_text("\n".join([line(), line(hqCity="x"), line(hqEvent="2"), "bad", line(hqSource="none")]) + "\n")
    for _ in range(2):
        jobs.clean_hour(spark, f"{root}/log", root, "20240102", 3, rejects=f"{root}/rejects")
        jobs.hourly_reports(spark, root, "20240102", 3)
    assert [r.value for r in spark.read.text(f"{root}/rejects").collect()] == ["bad"]
    assert read_slice(spark, f"{root}/tracking").count() == 3
    row = read_slice(spark, f"{root}/all_report").first()
    assert (row.impression, row.click, row.cost, row.platform, row.d, row.h) == (2, 1, 0.01, "tencent", "20240102", 3)
    assert sorted((r.city, r.impression, r.click) for r in read_slice(spark, f"{root}/geo_report").collect()) == [("-", 1, 1), ("x", 1, 0)]
    assert read_slice(spark, f"{root}/report").count() == read_slice(spark, f"{root}/channel_report").count() == 1


def test_traffic(spark, root, tmp_path):
    jobs.daily_traffic(spark, root, "20240102")
    total = read_slice(spark, f"{root}/bid_request", start="20240102", end="20240102").count()
    report = read_slice(spark, f"{root}/traffic_report")
    assert report.selectExpr("sum(count)").first()[0] == total > 0
    request = json.dumps({"id": 1, "platform": "youku", "start_time": "20240102", "end_time": "20240102", "type": "t", "filters": {}, "report": {"columns": "platform,day"}})
    jobs.traffic_request(spark, root, request, str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == [f"优酷视频,2024-01-02,{total}"]


def test_keywords(spark, root, tmp_path):
    (tmp_path / "pack").write_text("view\nclick\tc1\nk3\nu1\n")
    (tmp_path / "plain").write_text("view\nk3\nu1\n")
    jobs.keyword_page_views(spark, root, str(tmp_path / "plain"), "20240102")
    jobs.keyword_page_views(spark, root, str(tmp_path / "pack"), "20240102", by_channel=True)
    assert set(r.keyword for r in read_slice(spark, f"{root}/keyword_pv").collect()) <= {"view", "k3", "u1"}
    assert "click" in {r.keyword for r in read_slice(spark, f"{root}/channel_keyword_pv").collect()}
    jobs.keyword_relation_lines(spark, root, str(tmp_path / "plain"), "20240102", str(tmp_path / "relations"))
    lines = [r.value for r in spark.read.text(f"{tmp_path}/relations/20240102").collect()]
    relations = json.loads("{" + re.sub('}(?=")', "},", "".join(lines)) + "}")
    for word, entry in relations.items():
        assert sum(entry["relation"].values()) == entry["total"]
        assert all(relations[other]["relation"][word] == n for other, n in entry["relation"].items())
    request = json.dumps({"id": 4, "path": "plain"})
    fragments = jobs.reach_request(spark, root, str(tmp_path), request, "20240102").orderBy("at").collect()
    message = json.loads("".join(r.fragment for r in fragments))
    assert message["id"] == 4 and all(row["channel"] for row in message["data"])
    with pytest.raises(ValueError):
        jobs.reach_request(spark, root, str(tmp_path), json.dumps({"id": 4, "path": "plain", "platform": "iqiyi"}), "20240102")


def test_keyword_hour(spark, root, tmp_path):
    (tmp_path / "packs").mkdir()
    (tmp_path / "packs" / "one").write_text("PROMO\nred\n")
    (tmp_path / "packs" / "two").write_text("SMALL\n")
    (tmp_path / "map").write_text(json.dumps({"1": "one", "3": "two", "77": "two"}))
    deliveries = read_slice(spark, f"{root}/deliveries", legacy_names=True)
    day, hour = deliveries.where("request_time <> 0 and ad_id in ('1', '3')").selectExpr("d", "h").orderBy("d", "h").first()
    for scope in ("hour", "ad"):
        assert jobs.keyword_hour(spark, root, str(tmp_path / "map"), str(tmp_path / "packs"), day, hour, scope)
        rows = read_slice(spark, f"{root}/keyword_report", start=day, end=day).collect()
        assert sum(r.impression for r in rows) == deliveries.where(f"d = '{day}' and h = {hour} and request_time <> 0").count()
    assert not jobs.keyword_hour(spark, root, str(tmp_path / "map"), str(tmp_path / "packs"), day, 24)
    jobs.keyword_request(spark, root, f"{tmp_path}/kpis", day, day, ad_id=rows[0].ad_id, platform=rows[0].platform)
    lines = [r.value.split(",") for r in spark.read.text(f"{tmp_path}/kpis").collect()]
    wanted = [r.impression for r in rows if (r.ad_id, r.platform) == (rows[0].ad_id, rows[0].platform)]
    assert sum(int(line[1]) for line in lines) == sum(wanted)


def test_scratch_goes_with_the_job(spark, tmp_path):
    """Jobs leave no scratch tables, and publish the four reports in the form of the database."""
    (tmp_path / "log").write_text(line() + "\n")
    jobs.clean_hour(spark, f"{tmp_path}/log", str(tmp_path), "20240102", 3)
    home = f"{shared_root(spark)}/adtally/{spark.sparkContext.applicationId}"
    before = set(os.listdir(home)) if os.path.isdir(home) else set()
    published = {}
    jobs.hourly_reports(spark, str(tmp_path), "20240102", 3, publish=lambda rows, name: published.update({name: rows.columns}))
    assert set(os.listdir(home)) == before
    assert published.keys() == set(reports.GRAIN) and all({"day", "hour"} <= set(c) for c in published.values())


def test_anomaly(spark, root, tmp_path):
    day = "20240128"
    jobs.viewing_profiles(spark, root, "20240103", day)
    devices = read_slice(spark, f"{root}/device_profile", start=day, end=day)
    jobs.blocklists(spark, root, str(tmp_path / "lists"), day, ip_devices=11, ip_videos=30, device_videos=45, files=2)
    names = {r.value for r in spark.read.text(f"{tmp_path}/lists/device/{day}").collect()}
    assert names == {r.idfa for r in devices.where("vcount > 45").collect()} and names
    assert all(r.value.startswith("blk:") for r in spark.read.text(f"{tmp_path}/lists/ip/{day}").collect())
    jobs.detection(spark, root, day, parts=10)
    sections = read_slice(spark, f"{root}/sections")
    assert sections.where("target = 'device'").selectExpr("sum(n)").first()[0] == devices.count()
    assert sections.where("target = 'ip'").selectExpr("sum(n)").first()[0] == 20
    jobs.unlikely_names(spark, root, str(tmp_path / "unlikely"), day, 0.05, 1e-11)
    assert spark.read.text(f"{tmp_path}/unlikely/device/{day}").count() < devices.count()


def test_model(spark, root, tmp_path):
    (tmp_path / "columns").write_text("subchannel,sc\ncreative_id,cr\n")
    trained = jobs.conversion_model(spark, root, str(tmp_path / "columns"), "lr_1", "19970101", "19970110")
    home = f"{root}/models/lr_1"
    index = spark.read.parquet(f"{home}/index").count()
    assert spark.read.parquet(f"{home}/weights").count() == index == trained.model.numFeatures
    assert spark.read.text(f"{home}/auc").count() == 2
