"""Nearest neighbours against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtally.llm import neighbours
from adtally.llm.queries import op9_neighbours


def score(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += x * y
    return total


def brute(rows, k):
    """{query row: [(vec_id, score)]}; rows are (vec_id, vector)."""
    return {
        n: sorted(((-score(v, w), i) for m, (i, w) in enumerate(rows) if m != n and len(w) == len(v)))[:k]
        for n, (q, v) in enumerate(rows) if q % 20 == 0
    }


def listed(result):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in result.collect())


def expected(rows, k=neighbours.NEAREST):
    return sorted((rows[n][0], rank, i, -s) for n, best in brute(rows, k).items() for rank, (s, i) in enumerate(best, 1))


def test_query_recall(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got, want = listed(op9_neighbours(spark, path)), expected(rows)
    assert len(got) == len(want) and [g[:2] for g in got] == [w[:2] for w in want]
    pairs = {(q, i) for q, _, i, _ in want}
    assert len(pairs & {(q, i) for q, _, i, _ in got}) >= 0.9 * len(pairs)
    known = {i: v for i, v in rows}
    assert all(s == score(known[q], known[i]) for q, _, i, s in got)


@pytest.mark.parametrize("leaf", [4, 256])
def test_factor_one_is_exact(spark, monkeypatch, leaf):
    """Several shards, lengths that differ, many equal vectors."""
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 60)
    monkeypatch.setattr(neighbours, "BLOCK", 5)
    monkeypatch.setattr(neighbours, "LEAF", leaf)
    rng = random.Random(5)
    rows = [(n, [rng.gauss(0, 1) * rng.choice([1, 1, 3]) for _ in range(3)]) for n in range(150)]
    rows += [(n, [1.0, 2.0, 0.5]) for n in range(150, 230)] + [(n, [1.0, 0.0]) for n in range(230, 245)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as row", "3 as rank")
    assert listed(neighbours.nearest(table, F.col("vec_id") % 20 == 0, factor=1.0)) == expected(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]), (None, [5.0, 5.0]), (7, [2.0, 1.0]), (7, [2.0, 1.0]), (0, [1.0, 0.0]), (9, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert listed(neighbours.neighbour_report(table)) == sorted([
        (0, 1, 7, 2.0), (0, 2, 7, 2.0), (0, 3, 0, 1.0), (0, 1, 7, 2.0), (0, 2, 7, 2.0), (0, 3, 0, 1.0),
    ])


def test_empty_and_without_queries(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.neighbour_report(empty).collect() == []
    alone = spark.createDataFrame([(1, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")
    assert neighbours.neighbour_report(alone).collect() == []
    assert np.isfinite(neighbours.FACTOR)


@pytest.mark.parametrize("lengths", ["equal", "sd 0.1", "sd 0.3", "one of 2", "one of 100"])
@pytest.mark.parametrize("grouped", [False, True])
def test_recall_with_unequal_lengths(lengths, grouped):
    rng = np.random.default_rng(3)
    n, k = 8192, neighbours.NEAREST
    vectors = rng.normal(size=(n, 64))
    if grouped:
        vectors = 0.4 * vectors + rng.normal(size=(50, 64))[rng.integers(50, size=n)]
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    if lengths.startswith("sd"):
        vectors *= np.exp(float(lengths[3:]) * rng.normal(size=n))[:, None]
    elif lengths.startswith("one"):
        vectors[77] *= float(lengths[7:])
    asked = np.arange(0, n, 40)
    product = vectors[asked] @ vectors.T
    product[np.arange(len(asked)), asked] = -np.inf
    true = np.argsort(-product, axis=1)[:, :k]
    for factor, least in [(neighbours.FACTOR, 0.99), (1.0, 1.0)]:
        # In four shards, each started with the k-th scores of the first; and in one.
        for parts in (4, 1):
            found, low = [], np.full(len(asked), -np.inf)
            for part in range(parts):
                some = np.arange(part, n, parts)
                shard = neighbours.Shard.of(vectors[some], some, some)
                search = neighbours.Search(shard, neighbours.Block(vectors[asked], asked, asked, low), k, factor)
                search.run()
                if part == 0 and parts > 1:
                    low = search.score[:, -1]
                found.append(np.where(search.found >= 0, some[search.found], -1))
            found = [set(row.tolist()) for row in np.concatenate(found, axis=1)]
            recall = sum(len(set(a.tolist()) & b) for a, b in zip(true, found, strict=True)) / true.size
            assert recall >= least, (parts, recall)


def test_factor_one_is_exact_for_lengths_far_apart(spark, monkeypatch):
    """Lengths whose squares are lost or overflow, negative best scores, equal directions."""
    monkeypatch.setattr(neighbours, "LEAF", 4)
    rng = random.Random(6)
    rows = [(n, [rng.gauss(0, 1) * 10.0 ** (n % 7 * 80 - 240) for _ in range(2)]) for n in range(140)]
    rows += [(n, [1.0 * (n - 139), 2.0 * (n - 139)]) for n in range(140, 200)] + [(200, [-3.0, -6.0]), (220, [-1e-200, -1e-200])]
    # Products that overflow have no order.
    rows = [(n, v) for n, v in rows if max(map(abs, v)) < 1e150]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert listed(neighbours.nearest(table, F.col("vec_id") % 20 == 0, factor=1.0)) == expected(rows)
