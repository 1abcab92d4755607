"""Helpers: folds, samples, worker tables, hashes in segments."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from adtally.llm import hashing
from adtally.llm.common import columns_of, fold, own_prefix, sampled, worker_cache


def test_fold(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 1, 7, 99, -5)] + [(None,)], "doc_id long")
    got = [r.f for r in rows.select(fold(F.col("doc_id"), 4).alias("f")).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 4 for i in (0, 1, 7, 99, -5)] + [0]


def test_sample_is_bounded_and_outside_the_fold(spark):
    documents = spark.range(200).selectExpr("id as doc_id", "'t' as text", "1 as y")
    labels = spark.range(200).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic").union(
        spark.createDataFrame([(None, 1), (3, None), (4, 1)], "doc_id long, toxic int")
    )
    rows = sampled(documents, labels, "toxic", 4, 2, 50).collect()
    assert len(rows) == 50 == len({r.doc_id for r in rows})
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in rows)
    again = sampled(documents.repartition(7), labels, "toxic", 4, 2, 50).collect()
    assert {r.doc_id for r in again} == {r.doc_id for r in rows}
    every = {r.doc_id: r.y for r in sampled(documents, labels, "toxic", 4, 2, 1000).collect()}
    assert all(y == (1 if d == 4 else d % 2) for d, y in every.items())


def test_a_worker_keeps_one_operators_tables():
    worker_cache("one")["x"] = 1
    assert worker_cache("one") == {"x": 1}
    assert worker_cache("two") == {} and worker_cache("one") == {}


def test_segments_do_not_change_hashes(monkeypatch):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcDé\t") for _ in range(rng.randint(0, 9))) for _ in range(2000)).encode()
    text += b" " + b"q" * 900 + b" end"
    whole = hashing.hashed_prefixes(text, (3, 5))
    monkeypatch.setattr(hashing, "SEGMENT", 100)
    parts = hashing.hashed_prefixes(text, (3, 5))
    assert all(np.array_equal(a, b) for a, b in zip(whole[0], parts[0], strict=True))
    assert np.array_equal(whole[1], parts[1]) and np.array_equal(whole[2], parts[2])


def test_sample_bounds_rows_of_a_repeated_id(spark):
    documents = spark.range(5000).selectExpr("cast(1 as long) as doc_id", "concat('t', id) as text").union(
        spark.createDataFrame([(2, None), (2, None), (3, "x")], "doc_id long, text string")
    )
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    rows = sampled(documents, labels, "toxic", 4, 9, 10).collect()
    assert sorted((r.doc_id, r.text, r.y) for r in rows) == [(1, "t0", 1), (2, None, 0), (3, "x", 1)]


def test_own_prefix_and_names(spark):
    rows = spark.createDataFrame([(1, 2, 3, 4)], "`a.b` int, `c``d` int, _x int, __Y int")
    assert own_prefix(rows) == "___" and own_prefix(rows.select("`a.b`")) == "_"
    assert rows.select(*columns_of(rows)).collect() == rows.collect()
