import datetime as dt
import json
import os

from pyspark.sql import functions as F

from adtally.operators import reports
from adtally.session import shared_root
from adtally.sinks import jdbc as jdbc_sink
from adtally.sources import jdbc as jdbc_source
from adtally.sources.tables import read_slice
from adtally.streaming import report, windows


def line(stamp, **fields):
    base = {"hqClientId": "1", "hqSource": "bc", "hqEvent": "1", "hqPrice": "5"}
    return f"{stamp}\tad\t" + json.dumps({k: v for k, v in (base | fields).items() if v is not None})


def write(folder, name, *lines):
    """Put a complete file into the watched folder."""
    os.makedirs(folder, exist_ok=True)
    hidden = os.path.join(folder, f".{name}.tmp")
    with open(hidden, "w") as out:
        out.write("\n".join(lines) + "\n")
    os.rename(hidden, os.path.join(folder, name))


def run(spark, root, **options):
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{root}/in")
    report.start_report(lines, f"{root}/counts", f"{root}/state", **options).awaitTermination()


def totals(spark, root):
    rows = report.read_report(spark, f"{root}/counts").collect()
    return {(r.client_id, r.platform, r.d, r.h): (r.impression, r.click, r.cost) for r in rows}


def test_rows(spark):
    lines = [
        line("2024010207", hqPrice="x", hqGroupId="", tagId=" t 1 ", plmtid=None),
        line("2024010207", hqClientId=None, hqCliendId="2"),
        line("2024010207") + "\textra",
        line("20240102"),
        "no json",
    ]
    rows = report.stream_rows(spark.createDataFrame([(v,) for v in lines], "value string")).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.group_id, row.tag_id, row.placement_id, row.channel_id) == (0, "t1", "", "")
    assert (row.source, row.platform, float(row.price), row.d, row.h) == ("bc", "baidu_bc", 0.0, "20240102", 7)


def test_several_batches_late_data_and_restart(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/in", "1", line("2024010207"), line("2024010207", hqEvent="2"))
    write(f"{root}/in", "2", line("2024010208"), line("2024010207"))
    run(spark, root)
    assert totals(spark, root) == {("1", "baidu_bc", "20240102", 7): (2, 1, 0.01), ("1", "baidu_bc", "20240102", 8): (1, 0, 0.005)}
    write(f"{root}/in", "3", line("2024010100"), line("2024010207", hqClientId="9", hqSource="youku"))
    run(spark, root)
    run(spark, root)
    assert totals(spark, root) == {
        ("1", "baidu_bc", "20240102", 7): (2, 1, 0.01), ("1", "baidu_bc", "20240102", 8): (1, 0, 0.005),
        ("1", "baidu_bc", "20240101", 0): (1, 0, 0.005), ("9", "youku", "20240102", 7): (1, 0, 0.0),
    }


def test_replayed_batch_counts_once(spark, tmp_path):
    """A batch that was stored but not committed is stored again under the same name."""
    root = str(tmp_path)
    write(f"{root}/in", "1", line("2024010207"))
    write(f"{root}/in", "2", line("2024010207"), line("2024010209"))
    run(spark, root)
    before = totals(spark, root)
    commits = f"{root}/state/commits"
    for name in os.listdir(commits):
        if name.lstrip(".").startswith("1"):
            os.remove(os.path.join(commits, name))
    run(spark, root)
    assert totals(spark, root) == before


def test_stream_equals_batch(spark, tmp_path):
    root = str(tmp_path)
    lines = [line(f"20240102{i % 24:02d}", hqEvent=str(i % 8), hqSource=["bc", "tencent", "youku"][i % 3], hqPrice=f"{i}.25") for i in range(90)]
    for at in range(3):
        write(f"{root}/in", str(at), *lines[at * 30:(at + 1) * 30])
    run(spark, root, by=["d"])
    rows = report.stream_rows(spark.createDataFrame([(v,) for v in lines], "value string"))
    want = reports.finish(report.batch_counts(rows), positive_only=False)
    got = report.read_report(spark, f"{root}/counts")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_stream_without_a_usable_line(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/in", "1", "no json", line("20240102"))
    run(spark, root)
    assert totals(spark, root) == {}
    write(f"{root}/in", "2", line("2024010207"))
    run(spark, root)
    assert len(totals(spark, root)) == 1


def test_slice_condition_prunes_partitions(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/in", "1", line("2024010207"), line("2024010308"))
    run(spark, root)
    rows = report.read_report(spark, f"{root}/counts").where("d = '20240102' and h = 7")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "20240102" in filters and "h#" in filters
    assert rows.count() == 1


def test_fold_writes_its_rows_once(spark, tmp_path):
    """Folded days go straight to their folders; none of them are stored in the scratch folder before."""
    root = str(tmp_path)
    scratch = f"{shared_root(spark)}/adtally/{spark.sparkContext.applicationId}"
    write(f"{root}/in", "1", line("2024010207"), line("2024010308"))
    run(spark, root)
    before, had = totals(spark, root), set(os.listdir(scratch)) if os.path.exists(scratch) else set()
    report.fold(spark, f"{root}/counts", "d <= '20240102'")
    assert totals(spark, root) == before
    assert (set(os.listdir(scratch)) if os.path.exists(scratch) else set()) == had


def test_fold(spark, tmp_path):
    """Folding changes no total, also with late rows, repeated, or broken off before the batches go."""
    root = str(tmp_path)
    write(f"{root}/in", "1", line("2024010207"), line("2024010308"))
    write(f"{root}/in", "2", line("2024010207"))
    run(spark, root)
    before = totals(spark, root)
    folders = lambda kind: sorted(str(p.relative_to(tmp_path)) for p in (tmp_path / "counts" / kind).glob("d=*/**/*=*") if p.is_dir())
    held = len(folders("batches"))
    report.fold(spark, f"{root}/counts", "d = '20240102'")
    assert totals(spark, root) == before and len(folders("batches")) < held
    write(f"{root}/in", "3", line("2024010207"), line("2024010209"))
    run(spark, root)
    late = totals(spark, root)
    assert late[("1", "baidu_bc", "20240102", 7)][0] == before[("1", "baidu_bc", "20240102", 7)][0] + 1
    for _ in range(2):
        report.fold(spark, f"{root}/counts", "d = '20240102'")
        assert totals(spark, root) == late
    stored = read_slice(spark, f"{root}/counts/folded").where("d = '20240102'")
    assert stored.select("upto").distinct().count() == 1


def test_fold_without_removal(spark, tmp_path, monkeypatch):
    """Readers between the fold and the removal of its batches count each row once."""
    root = str(tmp_path)
    write(f"{root}/in", "1", line("2024010207"))
    write(f"{root}/in", "2", line("2024010207"))
    run(spark, root)
    before = totals(spark, root)
    monkeypatch.setattr(report, "drop_folder", lambda spark, path: None)
    for _ in range(2):
        report.fold(spark, f"{root}/counts", "d <= '20240102'")
        assert totals(spark, root) == before


def test_counts_to_a_database(spark, tmp_path):
    """Counters of batches are appended; a batch that comes again and other slices do no harm."""
    root = str(tmp_path)
    write(f"{root}/in", "1", line("2024010207"), line("2024010208"))
    write(f"{root}/in", "2", line("2024010207"), line("2024010209"))

    def append(counts, stream_id, batch_id):
        for _ in range(2):
            jdbc_sink.named_counts(counts, stream_id, batch_id).write.mode("append").parquet(f"{root}/table")

    run(spark, root, store=append)
    stored = spark.read.parquet(f"{root}/table")
    rows = jdbc_source.running_counts(stored.where("h in (7, 8)"), report.KEYS, reports.MEASURES).collect()
    assert {(r.h, r.impression) for r in rows} == {(7, 2), (8, 1)}
    every = jdbc_source.running_counts(stored, report.KEYS, reports.MEASURES).collect()
    assert {(r.h, r.impression) for r in every} == {(7, 2), (8, 1), (9, 1)}


WORDS = [("2024-01-01 00:00:05", "a b a"), ("2024-01-01 00:00:12", "a "), ("2024-01-01 00:00:31", "b  c"), ("2024-01-01 00:00:31", "   ")]


def words(spark):
    return spark.createDataFrame(WORDS, "ts string, value string").withColumn("ts", F.col("ts").cast("timestamp"))


def shown(df):
    return sorted((str(r.window_start)[-8:], r.word, r.n) for r in df.collect())


def test_sliding_counts(spark):
    assert shown(windows.sliding_counts(words(spark), None)) == [
        ("00:00:00", "a", 3), ("00:00:00", "b", 1), ("00:00:10", "a", 1),
        ("00:00:20", "", 1), ("00:00:20", "b", 1), ("00:00:20", "c", 1),
        ("00:00:30", "", 1), ("00:00:30", "b", 1), ("00:00:30", "c", 1),
        ("23:59:50", "a", 2), ("23:59:50", "b", 1),
    ]


def test_sliding_stream_equals_batch(spark, tmp_path):
    root = str(tmp_path)
    for at in range(2):
        words(spark).where(F.col("ts").cast("string").endswith("31") == F.lit(bool(at))).coalesce(1).write.mode("append").parquet(f"{root}/in")
    lines = spark.readStream.schema("ts timestamp, value string").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    counts = windows.sliding_counts(lines, None)
    windows.start_sliding_counts(counts, f"{root}/counts", f"{root}/state").awaitTermination()
    assert shown(windows.read_sliding_counts(spark, f"{root}/counts")) == shown(windows.sliding_counts(words(spark), None))


def stream_words(spark, root, folder, state):
    lines = spark.readStream.schema("ts timestamp, value string").option("maxFilesPerTrigger", 1).parquet(folder)
    started = windows.start_sliding_counts(windows.sliding_counts(lines, "1 minute"), f"{root}/counts", state)
    started.awaitTermination()
    return started


def put(spark, folder, rows):
    frame = spark.createDataFrame(rows, "ts string, value string").withColumn("ts", F.col("ts").cast("timestamp"))
    frame.coalesce(1).write.mode("append").parquet(folder)
    return frame


def test_sliding_streams_share_a_path(spark, tmp_path):
    """Two streams, one of them restarted without its checkpoint, and folding in between."""
    root = str(tmp_path)
    rows = [[(f"2024-01-01 00:0{n}:0{i}", f"w{i} x") for i in range(4)] for n in range(5)]
    for n in range(3):
        put(spark, f"{root}/one", rows[n])
    stream_words(spark, root, f"{root}/one", f"{root}/state-1")
    put(spark, f"{root}/two", rows[3])
    stream_words(spark, root, f"{root}/two", f"{root}/state-2")
    put(spark, f"{root}/later", rows[4])
    stream_words(spark, root, f"{root}/later", f"{root}/state-lost")
    every = spark.createDataFrame([r for part in rows for r in part], "ts string, value string").withColumn("ts", F.col("ts").cast("timestamp"))
    want = shown(windows.sliding_counts(every, None))
    assert shown(windows.read_sliding_counts(spark, f"{root}/counts")) == want
    folders = lambda: len(list((tmp_path / "counts").glob("stream_id=*/batch_id=*")))
    held = folders()
    for _ in range(2):
        windows.fold_sliding_counts(spark, f"{root}/counts")
        assert shown(windows.read_sliding_counts(spark, f"{root}/counts")) == want
    assert folders() < held


def test_counts_of_one_stream_are_read_in_one_aggregate(spark, tmp_path):
    """Later counts of a window replace earlier ones; only several streams are added up."""
    columns = "window_start timestamp, window_end timestamp, word string, n long, stream_id string, batch_id long"
    at = [dt.datetime(2024, 1, 1, 0, 0, 10 * n) for n in range(3)]
    rows = [(at[0], at[2], "a", n + 1, stream, n) for stream in ("one", "two") for n in range(11)] + [(at[0], at[2], None, 5, "one", 0)]
    root, exchanges = str(tmp_path / "stream_id=x" / "counts"), []
    for stream, times in (("one", 1), ("two", 2)):
        stored = spark.createDataFrame(rows, columns).where(F.col("stream_id") == stream)
        stored.write.mode("append").partitionBy("stream_id", "batch_id").parquet(root)
        read = windows.read_sliding_counts(spark, root)
        assert read.columns == ["window_start", "window_end", "word", "n"]
        assert sorted((str(r.word), r.n) for r in read.collect()) == [("None", 5), ("a", 11 * times)]
        exchanges.append(read._jdf.queryExecution().sparkPlan().toString().count("HashAggregate"))
    assert exchanges == [2, 4]


def test_watermark_bounds_the_state(spark, tmp_path):
    """After a later batch the state holds fewer windows than were ever open."""
    root = str(tmp_path)
    for n in range(4):
        put(spark, f"{root}/in", [(f"2024-01-01 0{n}:00:00", " ".join(f"w{i}" for i in range(50)))])
    started = stream_words(spark, root, f"{root}/in", f"{root}/state")
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in started.recentProgress if p["stateOperators"]]
    assert rows[-1] <= 200 < 4 * 100
