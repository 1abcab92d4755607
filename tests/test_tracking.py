import json

from pyspark.sql import functions as F

from adtally.operators import reports, tracking
from adtally.schemas import TRACKING


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def body(**fields):
    return json.dumps(fields)


def parsed(spark, *texts, **options):
    return tracking.parse_lines(lines(spark, *texts), **options)


def test_rejects(spark):
    good = "2024010203\tad\t" + body(hqSource="youku", hqClientId="1")
    bad = ["2024010203\tad", "2024010203\tad\t{broken", "2024010203\tad\t", "", "2024010203\tad\tnull"]
    frame = parsed(spark, good, *bad)
    assert sorted(r.value for r in tracking.rejected_lines(frame).collect()) == sorted(bad)
    assert tracking.normalize(frame).count() == 1


def test_exact_field_count(spark):
    four = "2024010203\tad\t" + body(hqSource="youku", hqClientId="1") + "\tmore"
    trailing = "2024010203\tad\t" + body(hqSource="youku", hqClientId="1") + "\t"
    assert [r.reject for r in parsed(spark, four).collect()] == [False]
    assert [r.reject for r in parsed(spark, four, exact_fields=True).collect()] == [True]
    assert [r.reject for r in parsed(spark, trailing, exact_fields=True).collect()] == [False]


def test_defaults(spark):
    frame = tracking.normalize(parsed(spark, "2024010207\tad\t" + body(
        hqCliendId="9", hqSource="tencent", hqPrice="", hqRefer="a \n b\tc", id="i7", extra={"x": 1}, hqEvent="1",
    ).replace("\\t", " ")))
    row = frame.first()
    assert frame.schema.names == TRACKING.names
    assert (row.client_id, row.group_id, row.ad_id, row.creative_id) == ("9", 0, 0, 0)
    assert (row.url, row.city, row.tag_id, row.channel_id) == ("-", "-", "-", "-")
    assert (float(row.price), row.refer, row.imp_id, row.placement_id) == (0.0, "abc", "i7", "")
    assert (row.cookie, row.did, row.d, row.h, row.event) == (None, None, "20240102", 7, 1)
    assert len(row.uuid) == 36


def test_client_id_prefers_the_right_spelling(spark):
    row = tracking.normalize(parsed(spark, "2024010207\tad\t" + body(hqClientId="1", hqCliendId="2", hqSource="letv", impid="m", plmtid="p"))).first()
    assert (row.client_id, row.imp_id, row.placement_id) == ("1", "m", "p")


def test_source_list(spark):
    texts = ["2024010207\tad\t" + body(hqSource=s) for s in ("other", "bc", "youku")] + ["2024010207\tad\t{}"]
    frame = parsed(spark, *texts)
    assert [r.source for r in tracking.normalize(frame).collect()] == ["youku"]
    assert sorted(r.source for r in tracking.normalize(frame, alias_first=True).collect()) == ["baidu_bc", "youku"]
    assert tracking.normalize(frame, sources=None).count() == 4
    assert tracking.normalize(frame, day="20200101", hour=5).select("d", "h").first() == ("20200101", 5)


def test_json_is_parsed_once(spark):
    frame = tracking.normalize(parsed(spark, "2024010207\tad\t{}"))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") <= 1


def test_round_trip(spark):
    rows = spark.createDataFrame(
        [("1", 2, 3, 4, "youku", 1, "5.5000", "20240101", 3)],
        "client_id string, group_id int, ad_id int, creative_id int, source string, event int, price string, d string, h int",
    )
    back = tracking.normalize(tracking.parse_lines(tracking.to_log_lines(rows, F.lit("2024010103"))))
    got = back.select(*rows.columns).withColumn("price", F.col("price").cast("string"))
    assert got.collect() == rows.collect()


def billed(spark, rule, rows):
    frame = spark.createDataFrame(rows, "source string, event int, price decimal(18,4)")
    price = F.when(rule(), F.coalesce("price", F.lit(0))).otherwise(F.lit(0)).cast("double")
    return [r[0] for r in frame.select(price).collect()]


def test_batch_billing(spark):
    from decimal import Decimal as D

    rows = [("tencent", 1, D(5)), ("tencent", 3, D(5)), ("youku", 3, D(5)), ("youku", 1, D(5)), ("baidu_bc", 1, D(5)), ("youku", 3, None), (None, 3, D(5))]
    assert billed(spark, reports.batch_billing, rows) == [5, 0, 5, 0, 5, 0, 5]


def test_stream_billing(spark):
    from decimal import Decimal as D

    rows = [("bc", 1, D(5)), ("bc", 3, D(5)), ("baidu_bc", 1, D(5)), ("youku", 3, D(5)), ("tencent", 1, D(5)), (None, 3, D(5))]
    assert billed(spark, reports.stream_billing, rows) == [5, 5, 0, 5, 5, 5]


def test_report_drops_rows_without_impression_or_cost(spark):
    rows = spark.createDataFrame(
        [("1", "tencent", 1, "5"), ("1", "tencent", 2, "0"), ("2", "youku", 1, "5"), ("3", "youku", 3, "5")],
        "client_id string, source string, event int, price string",
    ).withColumns({
        "price": F.col("price").cast("decimal(18,4)"), "d": F.lit("20240101"), "h": F.lit(1),
        **{c: F.lit(1) for c in ("group_id", "ad_id")}, "city": F.lit("x"),
    })
    got = reports.report(rows, "geo_report").collect()
    assert [(r.client_id, r.impression, r.click, r.cost) for r in got] == [("1", 1, 1, 0.005)]


def test_keyword_kpis(spark):
    rows = spark.createDataFrame(
        [("a", 10, 1, 150), ("a", 10, 2, 50), ("b", 0, 0, 0), ("c", 100, 3, 7)],
        "keyword string, impression long, click long, cost long",
    )
    got = [tuple(r) for r in reports.keyword_kpis(rows).collect()]
    assert got == [("c", 100, 3, 0.07, 3.0, 0.7), ("a", 20, 3, 2.0, 15.0, 100.0), ("b", 0, 0, 0.0, None, None)]


def test_database_form(spark):
    rows = spark.createDataFrame([("1", "p", "youku", 3, "20240102"), ("1", None, "youku", 3, "20240102")], "client_id string, placement_id string, platform string, h int, d string")
    stored = reports.database_rows(rows)
    assert sorted(stored.columns) == ["client_id", "day", "hour", "placementid", "platform"]
    assert str(stored.first().day) == "2024-01-02"
    back = reports.report_rows(stored).select(*rows.columns)
    assert [tuple(r) for r in back.collect()] == [("1", "p", "youku", 3, "20240102"), ("1", "", "youku", 3, "20240102")]


def test_time_bounds(spark):
    rows = spark.createDataFrame([("20240102", 1), ("20240101", 23), ("20240102", 0)], "d string, h int")
    assert tuple(reports.time_bounds(rows).first()) == ("20240101", 23, "20240102", 1)
