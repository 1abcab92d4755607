import gzip
import os

import pytest
from pyspark.sql import functions as F

from adtally import session
from adtally.schemas import BID_REQUEST
from adtally.sinks import files
from adtally.sinks import jdbc as jdbc_sink
from adtally.sources import jdbc, logs, tables


def report(spark, *rows):
    return spark.createDataFrame(rows, "k string, n long, d string, h int")


def stored(spark, path):
    return sorted((r.k, r.n, r.d, r.h) for r in tables.read_slice(spark, path).select("k", "n", "d", "h").collect())


def test_partitions_are_replaced_and_others_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_partitions(report(spark, ("a", 1, "20240101", 0), ("b", 2, "20240101", 1), ("c", 3, "20240102", 0)), path)
    files.replace_partitions(report(spark, ("x", 9, "20240101", 1)), path)
    assert stored(spark, path) == [("a", 1, "20240101", 0), ("c", 3, "20240102", 0), ("x", 9, "20240101", 1)]
    files.replace_partitions(report(spark, ("y", 8, "20240102", 0)), path, spread=False)
    assert ("y", 8, "20240102", 0) in stored(spark, path)


def test_slices_prune_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_partitions(report(spark, *[("a", i, f"202401{i:02d}", i % 3) for i in range(1, 9)]), path)
    df = tables.read_slice(spark, path, start="20240103", end="20240105", hour=1, columns=["k"])
    assert df.columns == ["k"] and df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "20240103" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<k:string>" in scan
    assert tables.read_slice(spark, path, start="20240107").count() == 2
    latest = tables.latest_partition(tables.read_slice(spark, path))
    assert [r.d for r in latest.collect()] == ["20240108"]


def test_legacy_names(spark, tmp_path):
    spark.createDataFrame([("7", "youku", "20240101", 1)], "hqadid string, hqsource string, d string, h int").write.partitionBy("d", "h").parquet(str(tmp_path / "t"))
    df = tables.read_slice(spark, str(tmp_path / "t"), legacy_names=True)
    assert sorted(df.columns) == ["ad_id", "d", "h", "source"]
    assert df.dtypes[df.columns.index("d")][1] == "string"


def test_platform_table():
    assert tables.platform_table("youku") == "bid_request"
    with pytest.raises(ValueError):
        tables.platform_table("letv")


def test_lines(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "x string, n int")
    files.write_lines(df, str(tmp_path / "t"), files=2, gzip=True)
    parts = [p for p in os.listdir(tmp_path / "t") if p.endswith(".txt.gz")]
    assert len(parts) == 2
    texts = sorted(line for p in parts for line in gzip.open(tmp_path / "t" / p, "rt").read().splitlines())
    assert texts == ["a\t1", "b\t"]
    files.write_lines(df.where("n = 1"), str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["a\t1"]


def test_file_ratio(spark):
    df = spark.range(10)
    assert files.with_file_ratio(df, 8, 3).rdd.getNumPartitions() == 2
    assert files.with_file_ratio(df, 2, 3).rdd.getNumPartitions() == 1


def test_gzip_logs_and_json_rows(spark, tmp_path):
    with gzip.open(tmp_path / "host.2024010203.gz", "wt") as out:
        out.write('{"d": "20240101", "h": 4}\n{"h": 5, "more": 1}\n')
    lines = logs.read_log_lines(spark, f"{tmp_path}/*.2024010203.gz")
    rows = logs.json_rows(lines, BID_REQUEST).select("d", "h", "channel").collect()
    assert sorted(map(tuple, rows), key=str) == [("20240101", 4, None), (None, 5, None)]


def test_jdbc_predicates():
    slices = [("20240101", 3), ("2024-01-01", 3), ("2024-01-02", 0)]
    assert jdbc.slice_predicates(slices) == ["day='2024-01-01' and hour=3", "day='2024-01-02' and hour=0"]
    assert jdbc.day_predicates(["20240101"], 2, 4) == ["day='2024-01-01' and hour between 2 and 4"]
    with pytest.raises(ValueError):
        jdbc.slice_predicates([("1 or 1=1", 0)])


def test_jdbc_counts(spark):
    """Equal rows of one batch count once; a read of some hours leaves the others as they are."""
    first = jdbc_sink.named_counts(spark.createDataFrame([("a", 1, 3), ("a", 2, 4), ("b", 3, 9)], "k string, h int, n long"), "s", 0)
    again = jdbc_sink.named_counts(spark.createDataFrame([("a", 1, 5)], "k string, h int, n long"), "s", 1)
    stored = first.union(first).union(again)
    got = sorted(map(tuple, jdbc.running_counts(stored, ["k", "h"], ["n"]).collect()))
    assert got == [("a", 1, 8), ("a", 2, 4), ("b", 3, 9)]
    some = jdbc.running_counts(stored.where("h < 3"), ["k", "h"], ["n"]).collect()
    assert sorted(map(tuple, some)) == got[:2] and stored.where("h = 3").count() == 2



def test_shared_root(spark, monkeypatch):
    assert session.scratch_path(spark, "x").startswith(session.shared_root(spark))

    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_root(Session())


def test_materialize_keeps_rows_and_types(spark):
    df = spark.createDataFrame([("a", [1, 2])], "k string, v array<int>")
    again = session.materialize(df, "t")
    assert again.schema == df.schema and again.collect() == df.collect()
    assert "FileScan" in again._jdf.queryExecution().executedPlan().toString()
