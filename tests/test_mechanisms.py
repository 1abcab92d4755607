"""Rollups, bucket merges, switched partitions, pruned scans, panes, and the portable split."""

import glob
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from adtally.operators import ctr, merge, profiles, rollups
from adtally.operators.slices import active_slices, in_slices
from adtally.operators.traffic import traffic_report
from adtally.plans import adapters as a
from adtally.plans import queries as q
from adtally.session import scratch_path, settings
from adtally.sinks.files import partitioned_table, replace_partitions, switch_partition
from adtally.sources.logs import stream_file_lines
from adtally.sources.requests import ReportSpec
from adtally.streaming import report, windows

SF = "/root/testdata/sf0.001"


def bag(df):
    return sorted(map(str, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def leaves(plan):
    """Scans of an executed plan, within its adaptive stages."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return leaves(plan.executedPlan())
    if "QueryStage" in name:
        return leaves(plan.plan())
    children = plan.children()
    return [plan] if children.isEmpty() else [leaf for i in range(children.size()) for leaf in leaves(children.apply(i))]


@pytest.fixture(scope="module")
def stored(spark):
    bids = a.bids(a.table(spark, SF, "events"))
    path = scratch_path(spark, "rollups")
    rollups.store_rollups(bids, path, [*q.GROUPINGS, ("channel", "day")])
    return bids, path


@pytest.mark.parametrize("request_text", [q.FULL_REQUEST, q.PLACEMENT_REQUEST])
def test_requests_are_answered_without_bids(spark, stored, request_text):
    bids, path = stored
    spec = ReportSpec.from_json(request_text)
    got = rollups.rollup_report(spark, path, spec, bids)
    assert bag(got) == bag(traffic_report(bids, spec))
    assert all("/rollups" in file for file in got.inputFiles()) and "events" not in " ".join(got.inputFiles())


def test_the_smallest_rollup_that_covers_a_request_is_taken(spark, stored):
    bids, path = stored
    known = rollups.stored_rollups(spark, path)
    assert len(known) == len(q.GROUPINGS)

    def chosen(columns, **filters):
        spec = ReportSpec("youku", "20240101", "20240131", columns, filters)
        found = rollups.smallest(known, rollups.needed_dimensions(spec))
        rows = rollups.rollup_report(spark, path, spec, bids)
        assert bag(rows) == bag(traffic_report(bids, spec))
        return found and set(found.dimensions)

    assert chosen(("day", "platform")) == {"hour"} or len(chosen(("day",))) == 1
    assert chosen(("device",), os=("IOS",)) == {"device", "os"}
    assert chosen(("hour",), channel=("c1",)) == {"hour", "device", "channel", "size", "os"}
    assert chosen(("tagid", "channel")) is None
    assert chosen(()) is not None
    assert chosen((), channel=("none",)) == {"channel"}
    with pytest.raises(ValueError):
        rollups.rollup_report(spark, path, ReportSpec("other", "20240101", "20240131", ("day",)), bids)


def test_a_merge_rewrites_touched_buckets_only(spark):
    path = scratch_path(spark, "buckets")
    table = spark.range(1000).selectExpr("cast(id as string) as k", "if(id = 3, null, cast(id % 5 as int)) as m", "id as n", "1 as one")
    assert merge.merge_into_buckets(table, path, ["k", "m"], ["n", "one"], 16) == list(range(16))
    files = set(glob.glob(f"{path.removeprefix('file://')}/bucket=*/*.parquet"))
    delta = spark.createDataFrame([("3", None, 10, 1), ("new", 1, 5, 1), ("3", None, 1, 1)], "k string, m int, n long, one int")
    touched = merge.merge_into_buckets(delta, path, ["k", "m"], ["n", "one"], 16)
    now = set(glob.glob(f"{path.removeprefix('file://')}/bucket=*/*.parquet"))
    assert 1 <= len(touched) <= 2
    assert {f.split("bucket=")[1].split("/")[0] for f in files - now} <= set(map(str, touched))
    assert {f for f in files if int(f.split("bucket=")[1].split("/")[0]) not in touched} <= now
    rows = {(r.k, r.m): (r.n, r.one) for r in merge.read_buckets(spark, path, table, ["k", "m"], ["n", "one"]).collect()}
    assert len(rows) == 1001 and rows["3", None] == (14, 3) and rows["new", 1] == (5, 1) and rows["7", 2] == (7, 1)
    assert merge.merge_into_buckets(delta.limit(0), path, ["k", "m"], ["n", "one"], 16) == []


def test_a_reader_planned_before_a_switch_gets_the_old_rows(spark):
    path, name = scratch_path(spark, "switch"), "switched"
    rows = spark.createDataFrame([(1, "d1"), (2, "d1"), (3, "d2")], "n int, d string")
    partitioned_table(rows, name, path)
    try:
        for day in ("d1", "d2"):
            switch_partition(rows.where(F.col("d") == day), name, path, "d", day)
        before = spark.table(name).where("d = 'd1'")
        before._jdf.queryExecution().executedPlan()
        folder = switch_partition(rows.where("n = 2").selectExpr("n * 10 as n", "d"), name, path, "d", "d1")
        assert sorted(r.n for r in before.collect()) == [1, 2]
        assert sorted((r.n, r.d) for r in spark.table(name).collect()) == [(3, "d2"), (20, "d1")]
        assert folder in spark.table(name).where("d = 'd1'").inputFiles()[0]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_slices_prune_the_scan_at_run_time(spark):
    path = scratch_path(spark, "by-day")
    tracking = a.tracking(a.table(spark, SF, "events"))
    replace_partitions(tracking, path, ["d"])
    slices = scratch_path(spark, "slices")
    active_slices(tracking, 7, ["d"]).write.parquet(slices)
    stored = spark.read.parquet(path).withColumn("d", F.col("d").cast("string"))
    rows = in_slices(stored, spark.read.parquet(slices).where("ad_id = 7"), ["d"])
    assert "dynamicpruning" in plan_of(rows).lower()
    assert "events.parquet" not in plan_of(rows)
    days = {r.d for r in spark.read.parquet(slices).collect()}
    assert rows.count() == tracking.where(F.col("d").isin(list(days))).count() and 0 < len(days) < 30
    executed = rows._jdf.queryExecution().executedPlan()
    rows._jdf.queryExecution().toRdd().count()
    scans = [s for s in leaves(executed) if "dynamicpruning" in s.toString().lower()]
    assert [int(s.metrics().apply("numPartitions").value()) for s in scans] == [len(days)]


def test_panes_give_the_same_windows_with_less_state(spark, tmp_path):
    """A minute by a second: every row is in sixty windows, and in one pane."""
    base = 1_700_000_000
    rows = [(base + n // 40, f"w{n % 3}") for n in range(4000)] + [(base + 5000, None)]
    lines = spark.createDataFrame(rows, "at long, value string").select(F.timestamp_seconds("at").alias("ts"), "value")
    want = bag(windows.sliding_counts(lines, None, "60 seconds", "1 second"))
    assert bag(windows.pane_counts(lines, None, "60 seconds", "1 second")) == want
    for part in (F.col("value").isNotNull(), F.col("value").isNull()):
        lines.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/lines")
        stream = spark.readStream.schema(lines.schema).parquet(f"{tmp_path}/lines")
        counts = windows.pane_counts(stream, "0 seconds", "60 seconds", "1 second")
        query = windows.start_sliding_counts(counts, f"{tmp_path}/counts", f"{tmp_path}/state", mode="append")
        query.awaitTermination()
        if not (tmp_path / "first").exists():
            (tmp_path / "first").touch()
            state = [s.numRowsTotal for s in query.recentProgress[0].stateOperators]
            # 100 panes of 3 words; the windows wait for closed panes. Sliding counts would hold 159 windows of 3 words.
            assert max(state) == 300 and sum(state) == 300
    assert bag(windows.read_sliding_counts(spark, f"{tmp_path}/counts")) == want


def test_panes_are_not_copied_into_every_window(spark, tmp_path):
    """Lines far apart: a pane goes into two rows of the second state at most, not into each of its six windows."""
    lines = spark.range(200).select(F.timestamp_seconds(F.col("id") * 610 + 7).alias("ts"), F.lit("a b").alias("value"))
    end = spark.sql("SELECT timestamp_seconds(1000000) AS ts, CAST(NULL AS STRING) AS value")
    written = []
    for rows in (lines, end):
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/lines")
        stream = spark.readStream.schema(lines.schema).parquet(f"{tmp_path}/lines")
        counts = windows.pane_counts(stream, "0 seconds", "60 seconds", "10 seconds")
        query = windows.start_sliding_counts(counts, f"{tmp_path}/counts", f"{tmp_path}/state", mode="append")
        query.awaitTermination()
        written += [[s.numRowsUpdated for s in p.stateOperators] for p in query.recentProgress]
    second, first = (sum(rows) for rows in zip(*written, strict=True))
    assert first == 400 and second <= 800
    stored = spark.read.parquet(f"{tmp_path}/counts")
    assert stored.count() == stored.select("window_start", "word").distinct().count() == 6 * 400
    assert bag(windows.read_sliding_counts(spark, f"{tmp_path}/counts")) == bag(windows.sliding_counts(lines, None, "60 seconds", "10 seconds"))


@pytest.mark.parametrize("size, slide, together", [
    ("60 seconds", "10 seconds", None), ("60 seconds", "10 seconds", 1), ("60 seconds", "10 seconds", 32), ("1 minute", "1 minute", None),
    ("25 seconds", "10 seconds", None), ("40 seconds", "1 second", None), ("2 days", "1 day", None),
])
def test_panes_of_any_length(spark, size, slide, together):
    """A window need not be a whole number of slides; times before 1970, at edges, and none at all."""
    at = F.when(F.col("id") % 50 > 0, (F.col("id") * F.col("id") * 7919) % 400_000_000 - 200_000_000)
    whole = F.when(F.col("id") % 3 == 0, F.floor(at / 10_000_000) * 10_000_000).otherwise(at)
    text = F.when(F.col("id") % 7 > 0, F.concat_ws(" ", F.lit("any"), F.concat(F.lit("w"), F.col("id") % 4)))
    lines = spark.range(1000).select(F.timestamp_micros(whole).alias("ts"), text.alias("value"))
    for kind in ("timestamp", "timestamp_ntz"):
        typed = lines.withColumn("ts", F.col("ts").cast(kind))
        want, got = windows.sliding_counts(typed, None, size, slide), windows.pane_counts(typed, None, size, slide, together)
        assert bag(want) and bag(got) == bag(want) and dict(got.dtypes) == dict(want.dtypes)


def test_settings_hold_within_a_block(spark):
    key = windows.STATE_STORE
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), settings(spark, {key: "x", "adtally.none": "1"}):
        assert spark.conf.get(key) == "x" and spark.conf.get("adtally.none") == "1"
        raise RuntimeError
    assert spark.conf.get(key) == before and spark.conf.get("adtally.none", None) is None


def test_the_split_is_the_same_for_any_partitioning(spark):
    rows = spark.range(5000).selectExpr("id % 1000 as key", "id")
    train, test = ctr.split_by_key(rows, "key", 0.8)
    again, _ = ctr.split_by_key(rows.repartition(7), "key", 0.8)
    keys = {r.key for r in train.collect()}
    assert keys == {r.key for r in again.collect()} and not keys & {r.key for r in test.collect()}
    assert keys == {n for n in range(1000) if int(hashlib.md5(str(n).encode()).hexdigest()[:8], 16) % 1000 < 800}
    assert train.count() + test.count() == 5000 and train.count() == 5 * len(keys)
    none = spark.createDataFrame([(None,)], "key long")
    assert sum(part.count() for part in ctr.split_by_key(none, "key")) == 1


def test_days_are_read_once(spark):
    """Profiles of overlapping ranges; bids of stored days are not looked at again."""
    bids = a.bids(a.table(spark, SF, "events"))
    path = scratch_path(spark, "daily-usage")
    assert profiles.update_usage(bids, path, "20240102", "20240104") == ["20240102", "20240103", "20240104"]
    nothing = bids.where("false")
    assert profiles.update_usage(nothing, path, "20240103", "20240105") == ["20240105"]
    assert profiles.update_usage(bids, path, "20240102", "20240105") == []
    for start, end in (("20240102", "20240104"), ("20240103", "20240105"), ("20240104", "20240104")):
        want = profiles.device_usage(bids.where("d != '20240105'"), start, end)
        got = profiles.stored_usage(spark, path, start, end)
        assert bag(profiles.device_profile(got)) == bag(profiles.device_profile(want))
        assert bag(profiles.ip_profile(got)) == bag(profiles.ip_profile(want))
    assert len(profiles.update_usage(bids, path, "20240228", "20240302")) == 4  # a leap day, and no bids


def test_the_state_of_a_stream_is_its_report(spark, tmp_path):
    fields = [("2024010207", "1", "5"), ("2024010207", "1", "2.5"), ("2024010208", "3", None)]
    for n, (stamp, event, price) in enumerate(fields * 2):
        log = {"hqClientId": "7", "hqSource": "bc", "hqEvent": event} | ({"hqPrice": price} if price else {})
        (tmp_path / "logs").mkdir(exist_ok=True)
        (tmp_path / "logs" / f"{n}.log").write_text(f"{stamp}\tad\t{json.dumps(log)}\n")
        if n in (2, 5):
            lines = stream_file_lines(spark, f"{tmp_path}/logs")
            report.start_state_report(lines, f"{tmp_path}/state").awaitTermination()
            rows = {r.h: (r.impression, r.cost) for r in report.read_state_report(spark, f"{tmp_path}/state").collect()}
            times = 1 if n == 2 else 2
            assert rows == {7: (2 * times, 0.0075 * times), 8: (0, 0.0)}
