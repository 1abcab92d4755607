"""The jobs end to end: read a slice, run an operator, replace a slice.

``root`` is the folder of the Parquet tables, one sub-folder per table, partitioned by day ``d``
and where it applies by hour ``h``. Running a job again for the same slice gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.operators import anomaly, ctr, features, keywords, profiles, reports, traffic
from adtally.operators.tracking import normalize, parse_lines, rejected_lines
from adtally.session import materialize, owns_scratch
from adtally.sinks.exports import json_message, save_model, write_fragments
from adtally.sinks.files import replace_partitions, write_csv, write_lines
from adtally.sources.logs import read_log_lines
from adtally.sources.models import read_libsvm
from adtally.sources.packs import (
    ad_keyword_pack,
    ad_pack_files,
    read_feature_columns,
    read_pack,
)
from adtally.sources.requests import ReachSpec, ReportSpec
from adtally.sources.tables import platform_table, read_slice


def _in_slice(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


# Tracking


@owns_scratch
def clean_hour(
    spark: SparkSession, logs: str | list[str], root: str, day: str, hour: int, rejects: str | None = None
) -> None:
    """Raw log files of an hour into the tracking table; rejected lines go to ``rejects``."""
    parsed = parse_lines(read_log_lines(spark, logs))
    rows = normalize(parsed, day=day, hour=hour)
    replace_partitions(rows, f"{root}/tracking", spread=False)
    if rejects:
        write_lines(rejected_lines(parsed), rejects, gzip=True)


@owns_scratch
def hourly_reports(
    spark: SparkSession, root: str, day: str, hour: int, publish: Callable[[DataFrame, str], None] | None = None
) -> None:
    """All four reports of an hour from one scan of the tracking table.

    ``publish`` gets the stored rows of each report in the form of the report database and its name,
    for example ``lambda rows, name: append_rows(rows, url, name, properties)``.
    """
    rows = read_slice(spark, f"{root}/tracking", start=day, end=day, hour=hour)
    finest = materialize(reports.rollup(rows, reports.FINEST), "rollup")
    for name, report in reports.reports_from(finest).items():
        replace_partitions(report, f"{root}/{name}")
        if publish:
            stored = read_slice(spark, f"{root}/{name}", start=day, end=day, hour=hour)
            publish(reports.database_rows(stored), name)


# Traffic


@owns_scratch
def daily_traffic(spark: SparkSession, root: str, day: str) -> None:
    bids = read_slice(spark, f"{root}/bid_request", start=day, end=day)
    replace_partitions(_in_slice(traffic.daily_traffic(bids), d=day), f"{root}/traffic_report", ["d"])


@owns_scratch
def traffic_request(spark: SparkSession, root: str, request: str, out: str) -> None:
    """CSV lines of an on-demand report: the requested columns, then the count."""
    spec = ReportSpec.from_json(request)
    bids = read_slice(spark, f"{root}/{platform_table(spec.platform)}", start=spec.start, end=spec.end)
    write_csv(traffic.display_rows(traffic.traffic_report(bids, spec)), out)


# Keywords


@owns_scratch
def keyword_page_views(
    spark: SparkSession, root: str, pack: str, day: str, by_channel: bool = False
) -> None:
    bids = read_slice(spark, f"{root}/bid_request", start=day, end=day)
    words = read_pack(spark, pack, first_field=by_channel)
    counts = (keywords.channel_keyword_pv if by_channel else keywords.keyword_pv)(bids, words)
    table = "channel_keyword_pv" if by_channel else "keyword_pv"
    replace_partitions(_in_slice(counts, d=day), f"{root}/{table}", ["system", "d"])


@owns_scratch
def keyword_relation_lines(
    spark: SparkSession, root: str, pack: str, day: str, out: str
) -> None:
    """Neighbours of every pack word as JSON fragments, in order."""
    bids = read_slice(spark, f"{root}/bid_request", start=day, end=day, columns=["keywords"])
    pairs = materialize(keywords.keyword_pairs(bids, read_pack(spark, pack)), "pairs")
    fragments = keywords.relation_fragments(keywords.keyword_relations(pairs))
    write_fragments(fragments, f"{out}/{day}", ["keyword", "part", "neighbour"])


def reach_request(
    spark: SparkSession, root: str, packs: str, request: str, day: str
) -> DataFrame:
    """The answer to a reach request as the fragments of one message."""
    spec = ReachSpec.from_json(request)
    if spec.platform != traffic.FULL_PLATFORM:
        raise ValueError(f"no reach estimate for platform {spec.platform!r}")
    bids = read_slice(spark, f"{root}/{platform_table(spec.platform)}", start=day, end=day)
    pack = read_pack(spark, f"{packs}/{spec.path}")
    return json_message(keywords.reach(traffic.reach_rows(bids, spec), pack, spec.platform), spec.id)


@owns_scratch
def keyword_hour(
    spark: SparkSession, root: str, pack_map: str, packs: str, day: str, hour: int, scope: str = "hour"
) -> bool:
    """Keyword performance of an hour; False when the hour has no deliveries.

    ``pack_map`` holds a JSON object from ad to file name, ``packs`` is the folder of the files.
    """
    deliveries = read_slice(
        spark, f"{root}/deliveries", start=day, end=day, hour=hour, legacy_names=True
    )
    rows = keywords.valid_deliveries(deliveries)
    if rows.isEmpty():
        return False
    ads = rows.select("ad_id").distinct()
    pack = ad_keyword_pack(spark, ad_pack_files(spark.read.text(pack_map)), packs, ads)
    report = keywords.first_match_report(rows, pack) if scope == "hour" else keywords.keyword_hour_report(rows, pack, scope)
    replace_partitions(report, f"{root}/keyword_report")
    return True


@owns_scratch
def keyword_request(
    spark: SparkSession, root: str, out: str, start: str, end: str, ad_id: str | None = None, platform: str | None = None
) -> None:
    """The key figures of a keyword request as CSV, over stored keyword reports."""
    rows = read_slice(spark, f"{root}/keyword_report", start=start, end=end)
    write_csv(reports.keyword_kpis(rows, ad_id=ad_id, platform=platform), out)


# Anomaly detection


@owns_scratch
def viewing_profiles(spark: SparkSession, root: str, start: str, end: str) -> None:
    """Device and IP profiles of a day range, stored under its last day."""
    bids = read_slice(spark, f"{root}/bid_request", start=start, end=end)
    usage = materialize(profiles.device_usage(bids), "usage")
    replace_partitions(_in_slice(profiles.device_profile(usage), d=end), f"{root}/device_profile", ["d"])
    replace_partitions(_in_slice(profiles.ip_profile(usage), d=end), f"{root}/ip_profile", ["d"])


def _profile(spark: SparkSession, root: str, target: str, day: str) -> DataFrame:
    return read_slice(spark, f"{root}/{target}_profile", start=day, end=day).drop("d")


@owns_scratch
def blocklists(
    spark: SparkSession,
    root: str,
    out: str,
    day: str,
    ip_devices: int,
    ip_videos: int,
    device_videos: int,
    files: int | None = None,
    ttl_days: int = 30,
) -> None:
    """Blocklists by viewing volume: name lists as text, and tables with counts and expiry."""
    lists = {
        "ip": anomaly.ip_blocklist(_profile(spark, root, "ip", day), ip_videos, ip_devices),
        "device": anomaly.device_blocklist(_profile(spark, root, "device", day), device_videos),
    }
    for target, rows in lists.items():
        rows = anomaly.with_expiry(rows, day, ttl_days)
        table = f"{root}/{target}_blocklist"
        replace_partitions(_in_slice(rows, d=day), table, ["d"])
        stored = read_slice(spark, table, start=day, end=day)
        write_lines(stored.select("name"), f"{out}/{target}/{day}", files)


@owns_scratch
def detection(spark: SparkSession, root: str, day: str, parts: int) -> None:
    """Scores of all profiles of a day and their histograms."""
    scorers = {"device": anomaly.device_scores, "ip": anomaly.ip_scores}
    for target, scorer in scorers.items():
        scored = scorer(_profile(spark, root, target, day))
        table = f"{root}/{target}_scores"
        replace_partitions(_in_slice(scored, d=day), table, ["d"])
        stored = read_slice(spark, table, start=day, end=day)
        bins = _in_slice(anomaly.histogram(stored, parts), d=day, target=target)
        replace_partitions(bins, f"{root}/sections", ["d", "target"])


@owns_scratch
def unlikely_names(
    spark: SparkSession,
    root: str,
    out: str,
    day: str,
    device_limit: float,
    ip_limit: float,
    files: int | None = None,
) -> None:
    """Name lists of devices and IPs whose probability is below a limit."""
    limits = {"device": (device_limit, ""), "ip": (ip_limit, anomaly.BLOCK_PREFIX)}
    for target, (limit, prefix) in limits.items():
        scored = read_slice(spark, f"{root}/{target}_scores", start=day, end=day)
        write_lines(anomaly.low_probability(scored, limit, prefix), f"{out}/{target}/{day}", files)


# Conversion model


@owns_scratch
def conversion_model(
    spark: SparkSession,
    root: str,
    column_file: str,
    model_id: str,
    start: str,
    end: str,
    train_share: float = 0.8,
    test_share: float = 0.2,
) -> ctr.Trained:
    """Dictionary, training rows, model, areas, weights and prefixes of a day range.

    Everything is stored below ``root/models/model_id``.
    """
    home = f"{root}/models/{model_id}"
    feature_columns = read_feature_columns(spark, column_file)
    columns = features.column_list(feature_columns)
    deliveries = read_slice(spark, f"{root}/deliveries", start=start, end=end, legacy_names=True)
    conversions = read_slice(spark, f"{root}/conversions", start=start, end=end)
    index = features.feature_index(features.feature_values(deliveries, columns))
    index.write.mode("overwrite").parquet(f"{home}/index")
    index = spark.read.parquet(f"{home}/index")
    rows = features.encode(features.labelled_rows(deliveries, conversions), index, columns)
    write_lines(features.libsvm_lines(rows), f"{home}/rows")
    trained = ctr.train(read_libsvm(spark, f"{home}/rows", index.count()), train_share, test_share)
    save_model(spark, trained, home)
    weights = ctr.weights(spark, trained.model, index, model_id)
    weights.write.mode("overwrite").parquet(f"{home}/weights")
    ctr.prefixes(feature_columns, model_id).write.mode("overwrite").parquet(f"{home}/prefixes")
    return trained
