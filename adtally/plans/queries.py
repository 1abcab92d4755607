"""One query per operator over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.functions.labels import TV_CHANNELS, register_sql_functions
from adtally.operators import anomaly, ctr, features, keywords, merge, profiles, reports, rollups, traffic
from adtally.operators.slices import active_slices, in_slices
from adtally.operators.tracking import normalize, parse_lines, rejected_lines, to_log_lines
from adtally.plans import adapters as a
from adtally.session import materialize, scratch_path
from adtally.sinks.exports import json_message
from adtally.sinks.files import partitioned_table, replace_partitions, switch_partition, write_lines
from adtally.sources.logs import inferred_json_rows, stream_file_lines
from adtally.sources.models import read_libsvm
from adtally.sources.offsets import stream_log_lines
from adtally.sources.packs import read_pack
from adtally.sources.requests import ReachSpec, ReportSpec
from adtally.streaming import report as stream
from adtally.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.tracking(a.table(spark, sf_dir, "events"))


def _bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.bids(a.table(spark, sf_dir, "events"))


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.deliveries(a.table(spark, sf_dir, "lineitem"), a.table(spark, sf_dir, "part"))


def _as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


# Tracking log and hourly reports


@query
def tracking_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = to_log_lines(
        _tracking(spark, sf_dir).withColumns({
            "id": F.col("event_id").cast("string"),
            "refer": F.concat_ws(" ", F.lit("from"), "client_id"),
        }),
        a.log_stamp(),
    )
    return _as_double(normalize(parse_lines(lines), with_uuid=False).drop("uuid"), "price")


def _dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of which some are broken, by event number: no JSON, two or four fields, blanks, no client."""
    rows = _tracking(spark, sf_dir).withColumns({
        "id": F.col("event_id").cast("string"),
        "tag_id": F.when(F.col("event_id") % 11 == 0, F.concat(F.lit(" t "), "tag_id")).otherwise(F.col("tag_id")),
        "client_id": F.when(F.col("event_id") % 13 == 0, None).otherwise(F.col("client_id")),
    })
    # The number stays beside the line until the line is spoiled by it.
    lines = to_log_lines(rows, F.concat_ws("#", a.log_stamp(), "id")).select(
        F.substring_index(F.substring_index("value", "\t", 1), "#", -1).cast("long").alias("n"),
        F.regexp_replace("value", "^([0-9]+)#[0-9]+", "$1").alias("value"),
    )
    n, value = F.col("n"), F.col("value")
    spoiled = (
        F.when(n % 5 == 1, F.concat(F.substring_index(value, "\t", 2), F.lit("\tno json "), n.cast("string")))
        .when(n % 7 == 2, F.concat(F.substring_index(value, "\t", 1), F.lit("\t"), n.cast("string")))
        .when(n % 9 == 4, F.concat(value, F.lit("\tmore")))
        .otherwise(value)
    )
    return lines.select(spoiled.alias("value"))


@query
def tracking_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw text of lines without a JSON object or with too few fields."""
    return rejected_lines(parse_lines(_dirty_lines(spark, sf_dir)))


@query
def stream_rows_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream keeps of the same lines, which are stored first, as a log is."""
    return _as_double(stream.stream_rows(materialize(_dirty_lines(spark, sf_dir), "log-lines")), "price")


@query
def all_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report(_tracking(spark, sf_dir), "all_report")


@query
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report(_tracking(spark, sf_dir), "report")


@query
def channel_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report(_tracking(spark, sf_dir), "channel_report")


@query
def geo_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report(_tracking(spark, sf_dir), "geo_report")


@query
def reports_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row and billing totals of the four reports, all derived from one stored rollup."""
    finest = materialize(reports.rollup(_tracking(spark, sf_dir), reports.FINEST), "rollup")
    parts = [
        df.agg(
            F.lit(name).alias("report"),
            F.count("*").alias("rows"),
            F.sum("impression").alias("impression"),
            F.sum((F.col("cost") * 1000).cast("decimal(28,4)")).cast("double").alias("billed"),
        )
        for name, df in reports.reports_from(finest).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def stream_billing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["client_id", "group_id", *reports.SLICE]
    counts = reports.rollup(_tracking(spark, sf_dir), keys, reports.stream_billing)
    return reports.finish(counts, positive_only=False)


@query
def batch_time_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.time_bounds(_tracking(spark, sf_dir))


# Traffic


@query
def traffic_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.daily_traffic(_bids(spark, sf_dir))


FULL_REQUEST = """{"id": 7, "platform": "youku", "start_time": "20240103", "end_time": "20240125",
 "type": "traffic", "filters": {"device": ["Mobile", "Tablet"], "os": ["IOS", "Android", "Windows"],
 "channel": ["c0", "c1", "c2", "c3", "c4"], "size": ["640x480", "1280x720"]},
 "report": {"columns": "day, hour,platform,device,channel,size,os,device,colour"}}"""

PLACEMENT_REQUEST = """{"id": 8, "platform": "youku", "start_time": "20240101",
 "end_time": "20240131", "type": "traffic", "filters": {"tagid": ["1", "2", "3", "5", "8", "13"],
 "placementid": ["p1", "p2", "p3", "p5", "p8"]}, "report": {"columns": "placementid,tagid,day"}}"""

PLAIN_REQUEST = """{"id": 9, "platform": "iqiyi", "start_time": "20240101", "end_time": "20240120",
 "type": "traffic", "filters": {"device": ["PC"]}, "report": {"columns": "day,hour,device,platform"}}"""


def _traffic(spark: SparkSession, sf_dir: str, request: str) -> DataFrame:
    spec = ReportSpec.from_json(request)
    return traffic.display_rows(traffic.traffic_report(_bids(spark, sf_dir), spec))


@query
def traffic_dynamic_youku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _traffic(spark, sf_dir, FULL_REQUEST)


@query
def traffic_dynamic_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _traffic(spark, sf_dir, PLACEMENT_REQUEST)


@query
def traffic_dynamic_iqiyi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _traffic(spark, sf_dir, PLAIN_REQUEST)


REQUESTS = {"full": FULL_REQUEST, "placement": PLACEMENT_REQUEST, "plain": PLAIN_REQUEST}
#: Groupings that are kept: one each for requests by client and by place, coarse ones, and the hours of a platform without more.
GROUPINGS = [
    ("hour", "device", "channel", "size", "os"), ("tagid", "placementid"), ("device", "os"), ("channel",), ("hour",),
]


@query
def traffic_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three requests above, answered from stored rollups."""
    bids, parts = _bids(spark, sf_dir), []
    paths = {platform: scratch_path(spark, f"rollups-{platform}") for platform in ("youku", "iqiyi")}
    rollups.store_rollups(bids, paths["youku"], GROUPINGS)
    rollups.store_rollups(bids, paths["iqiyi"], [("hour",)], "iqiyi")
    for name, request in REQUESTS.items():
        spec = ReportSpec.from_json(request)
        rows = traffic.display_rows(rollups.rollup_report(spark, paths[spec.platform], spec, bids))
        parts.append(rows.withColumn("request", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


REACH_WORDS = ["click", "signup", "k3", "k7", "u1"]
REACH_REQUEST = """{"id": 7, "path": "packs:one", "channel": ["c0", "c1", "c2", "%s", "c5"],
 "device": ["Mobile", "PC"], "size": ["640x480"], "system": ["Windows", "Linux", "Mac", "IOS", "Android", "Other"],
 "placementid": ["augc", "atv", "kugc", "ktv", "zugc", "ztv", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10"]}""" % TV_CHANNELS[0]


def _reach(spark: SparkSession, sf_dir: str, spec: ReachSpec) -> DataFrame:
    """Requests know systems in small letters; one channel in eight is a television channel."""
    bids = _bids(spark, sf_dir).withColumns({
        "os": F.lower("os"), "channel": F.when(F.col("channel") == "c3", TV_CHANNELS[0]).otherwise(F.col("channel")),
    })
    rows = traffic.reach_rows(bids, spec)
    return keywords.reach(rows, a.fixed_pack(spark, REACH_WORDS), spec.platform)


@query
def reach_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reach(spark, sf_dir, ReachSpec.from_json(REACH_REQUEST))


@query
def reach_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReachSpec(id=7)
    return json_message(_reach(spark, sf_dir, spec), spec.id)


# Keywords


def _keyword_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.delivery_bids(_deliveries(spark, sf_dir))


@query
def keyword_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.keyword_pv(_keyword_bids(spark, sf_dir), a.fixed_pack(spark))


@query
def keyword_pv_from_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views of the words of two pack files, of which the first field counts."""
    path, part = scratch_path(spark, "packs"), a.table(spark, sf_dir, "part")
    write_lines(part.select("p_brand", "p_name").where("p_partkey % 2 = 0"), f"{path}/brands", files=3)
    write_lines(part.select(F.split_part("p_name", F.lit(" "), F.lit(1)), "p_type").where("p_partkey % 3 = 0"), f"{path}/names")
    pack = read_pack(spark, f"{path}/brands,{path}/names", first_field=True)
    return keywords.keyword_pv(_keyword_bids(spark, sf_dir), pack.distinct())


@query
def systems_by_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bid requests per system, by the function that SQL can call."""
    register_sql_functions(spark)
    _bids(spark, sf_dir).createOrReplaceTempView("bids_with_systems")
    return spark.sql("SELECT checkos(os) AS system, count(*) AS n FROM bids_with_systems GROUP BY ALL")


@query
def channel_keyword_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.channel_keyword_pv(_keyword_bids(spark, sf_dir), a.fixed_pack(spark))


@query
def keyword_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.keyword_pairs(_keyword_bids(spark, sf_dir), a.fixed_pack(spark))


@query
def keyword_pairs_large_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pack of every type, brand and name word there is."""
    pack = a.ad_pack(a.table(spark, sf_dir, "part")).select("keyword").distinct()
    return keywords.keyword_pairs(_keyword_bids(spark, sf_dir), pack)


@query
def keyword_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.keyword_relations(keyword_pairs(spark, sf_dir))


@query
def relation_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments over words that hold quotes and backslashes."""
    bids = _keyword_bids(spark, sf_dir)
    quoted = F.transform("keywords", lambda w: F.concat(F.substring(w, 1, 3), F.lit('"\\'), F.substring(w, 4, 100)))
    pack = a.fixed_pack(spark).select(
        F.concat(F.substring("keyword", 1, 3), F.lit('"\\'), F.substring("keyword", 4, 100)).alias("keyword")
    )
    pairs = materialize(keywords.keyword_pairs(bids.withColumn("keywords", quoted), pack), "pairs")
    return keywords.relation_fragments(keywords.keyword_relations(pairs))


@query
def keyword_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.first_match_report(_deliveries(spark, sf_dir), a.fixed_pack(spark))


def _hour_report(spark: SparkSession, sf_dir: str, scope: str) -> DataFrame:
    pack = a.ad_pack(a.table(spark, sf_dir, "part"))
    return keywords.keyword_hour_report(_deliveries(spark, sf_dir), pack, scope)


@query
def keyword_hour_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hour_report(spark, sf_dir, "hour")


@query
def keyword_hour_report_per_ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hour_report(spark, sf_dir, "ad")


@query
def keyword_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.keyword_kpis(keyword_first_match(spark, sf_dir))


@query
def keyword_kpis_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of one ad and platform over a range of days."""
    rows = keyword_first_match(spark, sf_dir)
    return reports.keyword_kpis(rows, start="19940101", end="19961231", ad_id="7", platform="O")


# Anomaly detection


def _usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.device_usage(_bids(spark, sf_dir), "20240102", "20240129")


@query
def device_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.device_profile(_usage(spark, sf_dir))


@query
def ip_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.ip_profile(_usage(spark, sf_dir))


RANGES = [("20240102", "20240110"), ("20240105", "20240115"), ("20240110", "20240129")]


@query
def device_profile_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of three ranges that overlap, from stored days; each day's bids are read once."""
    path, parts = scratch_path(spark, "daily-usage"), []
    for start, end in RANGES:
        profiles.update_usage(_bids(spark, sf_dir), path, start, end)
        rows = profiles.device_profile(profiles.stored_usage(spark, path, start, end))
        parts.append(rows.withColumn("start", F.lit(start)))
    return reduce(DataFrame.unionByName, parts)


def _device_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.device_scores(materialize(device_profile(spark, sf_dir), "device-profile"))


def _ip_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.ip_scores(materialize(ip_profile(spark, sf_dir), "ip-profile"))


def _rounded(scored: DataFrame) -> DataFrame:
    return scored.select("name", *[
        F.round(name, 6).alias(name) for name in scored.columns if name.startswith("ln_")
    ])


@query
def device_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_device_scores(spark, sf_dir))


@query
def ip_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_ip_scores(spark, sf_dir))


PARTS = 20


def _bins(scored: DataFrame, name: str) -> DataFrame:
    bins = anomaly.histogram(materialize(scored.select("probability"), name), PARTS)
    return bins.select("bin", F.round(F.log("edge"), 6).alias("ln_edge"), "n")


@query
def device_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bins(_device_scores(spark, sf_dir), "device-scores")


@query
def ip_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bins(_ip_scores(spark, sf_dir), "ip-scores")


@query
def ip_blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.with_expiry(
        anomaly.ip_blocklist(ip_profile(spark, sf_dir), videos=290, devices=110), "20240129"
    )


@query
def device_blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.with_expiry(
        anomaly.device_blocklist(device_profile(spark, sf_dir), videos=50), "20240129"
    )


@query
def low_probability_blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = anomaly.low_probability(_device_scores(spark, sf_dir), 0.1)
    ips = anomaly.low_probability(_ip_scores(spark, sf_dir), 1e-4, anomaly.BLOCK_PREFIX)
    return devices.withColumn("target", F.lit("idfa")).unionByName(
        ips.withColumn("target", F.lit("ip"))
    )


# Merges and sinks

BOUNDARY = "20240115"
ACTIVE_AD = 7
REPORT_KEYS = reports.GRAIN["all_report"]


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored counters up to the boundary day and new counters from it on."""
    rows = _tracking(spark, sf_dir)
    return (
        reports.rollup(rows.where(F.col("d") <= BOUNDARY), REPORT_KEYS),
        reports.rollup(rows.where(F.col("d") >= BOUNDARY), REPORT_KEYS),
    )


@query
def report_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, delta = _halves(spark, sf_dir)
    merged = merge.additive_merge(target, delta, REPORT_KEYS, reports.MEASURES, counted=True)
    return reports.finish(merged, positive_only=False)


@query
def report_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, delta = _halves(spark, sf_dir)
    return reports.finish(merge.new_rows(delta, target, REPORT_KEYS), positive_only=False)


@query
def report_stored_beside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New counters with what is stored for their keys, if anything."""
    target, delta = _halves(spark, sf_dir)
    rows = merge.stored_beside(delta, target, REPORT_KEYS, ["impression", "billed"])
    return _as_double(rows.select(*REPORT_KEYS, "impression", "stored_impression", "stored_billed"), "stored_billed")


@query
def report_updated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, delta = _halves(spark, sf_dir)
    rows = merge.updated_rows(delta, target, REPORT_KEYS, reports.MEASURES)
    return reports.finish(rows, positive_only=False)


@query
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report by day whose days from the boundary on are written again under other billing."""
    path = scratch_path(spark, "partition-replace")
    keys = ["client_id", *reports.SLICE]
    rows = _tracking(spark, sf_dir)
    replace_partitions(reports.rollup(rows, keys), path, ["d"])
    later = rows.where(F.col("d") >= BOUNDARY)
    replace_partitions(reports.rollup(later, keys, reports.stream_billing), path, ["d"])
    stored = spark.read.parquet(path).withColumn("d", F.col("d").cast("string"))
    return reports.finish(stored, positive_only=False)


@query
def report_merge_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge in place: only the buckets of the keys of a batch are written again."""
    path = scratch_path(spark, "report-buckets")
    target, delta = _halves(spark, sf_dir)
    for rows in (target, delta):
        merge.merge_into_buckets(rows, path, REPORT_KEYS, reports.MEASURES, 32)
    stored = merge.read_buckets(spark, path, target, REPORT_KEYS, reports.MEASURES).drop(merge.BUCKET)
    return reports.finish(stored, positive_only=False)


@query
def partition_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report table by day, some of whose days are switched to rows under other billing."""
    path, name = scratch_path(spark, "partition-switch"), f"report_{uuid.uuid4().hex}"
    keys = ["client_id", *reports.SLICE]
    rows = _tracking(spark, sf_dir)
    first = materialize(reports.rollup(rows, keys), "first-billing")
    later = rows.where(F.col("d").between(BOUNDARY, "20240118"))
    second = materialize(reports.rollup(later, keys, reports.stream_billing), "second-billing")
    partitioned_table(first, name, path)
    for version in (first.where(F.col("d") >= "20240112"), second):
        for row in version.select("d").distinct().orderBy("d").collect():
            switch_partition(version.where(F.col("d") == row.d), name, path, "d", row.d)
    return reports.finish(spark.table(name), positive_only=False)


@query
def active_day_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the days on which an ad was active; days come from a join and prune the stored table as it runs."""
    path = scratch_path(spark, "tracking-by-day")
    replace_partitions(_tracking(spark, sf_dir), path, ["d"])
    active = materialize(active_slices(_tracking(spark, sf_dir), ACTIVE_AD, ["d"]), "active-days")
    stored = spark.read.parquet(path).withColumn("d", F.col("d").cast("string"))
    rows = in_slices(stored, active.where(F.col("ad_id") == ACTIVE_AD), ["d"])
    return reports.finish(reports.rollup(rows, ["client_id", *reports.SLICE]), positive_only=False)


# Streams


def _line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_log_lines(a.tracking(a.stream_table(spark, sf_dir, "events")), a.log_stamp())


@query
def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-report")
    started = stream.start_report(_line_stream(spark, sf_dir), f"{path}/counts", f"{path}/state", by=["d"])
    started.awaitTermination()
    return stream.read_report(spark, f"{path}/counts")


@query
def stream_state_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from the state of a query that was started twice, each time with new files."""
    path = scratch_path(spark, "stream-state")
    lines = to_log_lines(_tracking(spark, sf_dir), a.log_stamp())
    stored = materialize(lines.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(2))), "log-lines")
    for part in range(2):
        stored.where(F.col("part") == part).drop("part").write.mode("append").text(f"{path}/logs")
        stream.start_state_report(stream_file_lines(spark, f"{path}/logs"), f"{path}/state").awaitTermination()
    return stream.read_state_report(spark, f"{path}/state")


@query
def stream_replay_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch stored twice counts once."""
    path = scratch_path(spark, "stream-replay")
    lines = to_log_lines(_tracking(spark, sf_dir), a.log_stamp())
    counts = materialize(stream.batch_counts(stream.stream_rows(lines)), "stream-batch")
    for _ in range(2):
        stream.store_batch(counts, path, "one", 0, by=["d"])
    return stream.read_report(spark, path)


@query
def stream_report_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, the second and third with late hours for days that are folded before them."""
    path = scratch_path(spark, "stream-folded")
    parts = F.pmod(F.xxhash64("value"), F.lit(3))
    lines = materialize(to_log_lines(_tracking(spark, sf_dir), a.log_stamp()).withColumn("part", parts), "log-lines")
    for batch in range(3):
        rows = stream.stream_rows(lines.where(F.col("part") == batch))
        stream.store_batch(stream.batch_counts(rows), path, "one", batch, by=["d"])
        stream.fold(spark, path, f"d <= '{BOUNDARY}'" if batch < 2 else "d > '20240120'")
    return stream.read_report(spark, path)


@query
def stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-windows")
    lines = a.stream_table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat_ws(" ", "event_type", F.lit("any")).alias("value"),
    )
    counts = windows.sliding_counts(lines, watermark=None)
    windows.start_sliding_counts(counts, f"{path}/counts", f"{path}/state").awaitTermination()
    return _window_rows(spark, f"{path}/counts")


@query
def stream_pane_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a minute every ten seconds, as sums of panes; a later line without words ends the last of them."""
    path = scratch_path(spark, "stream-panes")
    lines = a.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.concat_ws(" ", "event_type", F.lit("any")).alias("value")
    )
    end = lines.agg(F.max("ts") + F.expr("INTERVAL 1 DAY")).select(F.col("*"), F.lit(None).cast("string")).toDF("ts", "value")
    for rows in (lines, end):
        rows.write.mode("append").parquet(f"{path}/lines")
        stored = spark.readStream.schema(lines.schema).parquet(f"{path}/lines")
        counts = windows.pane_counts(stored, "0 seconds", "60 seconds", "10 seconds")
        windows.start_sliding_counts(counts, f"{path}/counts", f"{path}/state", mode="append").awaitTermination()
    return _window_rows(spark, f"{path}/counts")


def _window_rows(spark: SparkSession, path: str) -> DataFrame:
    stamp = "yyyy-MM-dd HH:mm:ss"
    return windows.read_sliding_counts(spark, path).select(
        F.date_format("window_start", stamp).alias("window_start"),
        F.date_format("window_end", stamp).alias("window_end"),
        "word",
        "n",
    )


START_DAY, START_LINE = "20240110", 5


@query
def stream_from_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report that starts within a day's file, stops when the days up to the boundary are read, and goes on with the rest."""
    path = scratch_path(spark, "stream-offsets")
    rows = _tracking(spark, sf_dir).withColumn("id", F.col("event_id").cast("string"))
    lines = to_log_lines(rows, a.log_stamp()).select(
        "value", F.substring("value", 1, 8).alias("d"), F.regexp_extract("value", '"id":"([0-9]+)"', 1).cast("long").alias("n")
    )
    stored = materialize(lines, "log-lines")
    for days in (F.col("d") <= BOUNDARY, F.col("d") > BOUNDARY):
        part = stored.where(days).repartition("d").sortWithinPartitions("d", "n").drop("n")
        part.write.mode("append").partitionBy("d").text(f"{path}/logs")
        file = spark.read.text(f"{path}/logs").where(F.col("d") == START_DAY).select("_metadata.file_name").first()
        start = {"file": f"d={START_DAY}/{file.file_name}", "line": START_LINE}
        logs = stream_log_lines(spark, f"{path}/logs", start)
        stream.start_report(logs, f"{path}/counts", f"{path}/state", by=["d"]).awaitTermination()
    return stream.read_report(spark, f"{path}/counts")


@query
def stream_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running report with one file admitted to a batch, and how many batches there were."""
    path = scratch_path(spark, "stream-limited")
    lines = to_log_lines(_tracking(spark, sf_dir), a.log_stamp())
    write_lines(materialize(lines, "log-lines"), f"{path}/logs", files=LIMITED_FILES)
    logs = stream_file_lines(spark, f"{path}/logs", max_files_per_trigger=1)
    stream.start_report(logs, f"{path}/counts", f"{path}/state", by=["d"]).awaitTermination()
    batches = spark.read.parquet(f"{path}/counts/batches").agg(F.countDistinct("batch_id"))
    return stream.read_report(spark, f"{path}/counts").withColumn("batches", batches.scalar())


LIMITED_FILES = 5


@query
def json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON texts with differing fields, a field of two types and a nested one, some of them no JSON at all."""
    n, events = F.col("event_id"), a.table(spark, sf_dir, "events")
    texts = (
        F.when(n % 4 == 0, F.to_json(F.struct(n.alias("id"), (n % 100).alias("v"), F.struct((n % 7).alias("k")).alias("props"))))
        .when(n % 4 == 1, F.to_json(F.struct(n.alias("id"), F.col("event_type").alias("v"), F.col("user_id").alias("user"))))
        .when(n % 4 == 2, F.to_json(F.struct(n.alias("id"), (n % 8 / 8).alias("w"))))
        .otherwise(F.concat(F.lit("no json "), n.cast("string")))
    )
    rows = inferred_json_rows(materialize(events.select(texts.alias("value")), "json-texts"))
    return rows.select("id", "v", "user", F.col("props.k").alias("k"), F.col("w").cast("double").alias("w"))


# Conversion model


@query
def ctr_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and conversions of both parts of a split by click."""
    rows = features.labelled_rows(_deliveries(spark, sf_dir), a.conversions(a.table(spark, sf_dir, "orders")))
    parts = zip(("train", "test"), ctr.split_by_key(rows, "click_uuid", 0.8), strict=True)
    counted = [
        part.groupBy("subchannel").agg(F.count("*").alias("n"), F.sum("label").alias("converted")).withColumn("part", F.lit(name))
        for name, part in parts
    ]
    return counted[0].unionByName(counted[1])


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_index(features.feature_values(_deliveries(spark, sf_dir), a.FEATURES))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.labelled_rows(
        _deliveries(spark, sf_dir), a.conversions(a.table(spark, sf_dir, "orders"))
    )


@query
def feature_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir)


@query
def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("click_uuid", "subchannel", "creative_id", "label")


def _libsvm(spark: SparkSession, sf_dir: str, index: DataFrame) -> DataFrame:
    encoded = features.encode(_labelled(spark, sf_dir), index, a.FEATURES)
    return features.libsvm_lines(encoded)


@query
def libsvm_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _libsvm(spark, sf_dir, materialize(_index(spark, sf_dir), "feature-index"))


def _trained(spark: SparkSession, sf_dir: str) -> tuple[ctr.Trained, DataFrame]:
    index = materialize(_index(spark, sf_dir), "feature-index")
    path = scratch_path(spark, "libsvm")
    write_lines(_libsvm(spark, sf_dir, index), path)
    return ctr.train(read_libsvm(spark, path, index.count())), index


@query
def ctr_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of a fixed score with thousands of distinct values: a delivery's share of a whole price."""
    rows = features.labelled_rows(
        _deliveries(spark, sf_dir), a.conversions(a.table(spark, sf_dir, "orders"))
    )
    scored = rows.select(F.col("label").cast("double").alias("label"), (F.col("price").cast("double") / 200000).alias("score"))
    areas = ctr.areas(scored)
    return spark.createDataFrame([(name, round(value, 6)) for name, value in areas.items()], "metric string, value double")


@query
def ctr_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At the optimum the mean fitted probability of a feature's rows is their mean label."""
    index = materialize(_index(spark, sf_dir), "feature-index")
    encoded = features.encode(_labelled(spark, sf_dir), index, a.FEATURES)
    path = scratch_path(spark, "libsvm")
    write_lines(features.libsvm_lines(encoded), path)
    rows = ctr.equal_rows(read_libsvm(spark, path, index.count()))
    return ctr.feature_means(ctr.fit(rows), rows, index).select(
        "feature", F.round("mean_label", 3).alias("mean_label"), F.round("mean_score", 3).alias("mean_score")
    )


@query
def ctr_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctr.metrics_frame(spark, _trained(spark, sf_dir)[0])


@query
def ctr_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, index = _trained(spark, sf_dir)
    return ctr.weights(spark, trained.model, index, "lr_1")
