"""Near-duplicates against every pair of sets."""

import random
import re

import pytest

from adtally.llm import neardup
from adtally.llm.components import components
from adtally.llm.queries import op8_near_duplicates


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows, size):
    """{doc_id: (n, component)} by comparing all sets that share a shingle."""
    sets = {d: shingles(t, size) for d, t in rows}
    holders, above = {}, {d: d for d in sets}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)

    def top(d):
        while above[d] != d:
            d = above[d]
        return d

    for d, s in sets.items():
        for e in {e for x in s for e in holders[x] if e < d}:
            both = len(s & sets[e])
            if top(d) != top(e) and 100 * both >= 80 * (len(s) + len(sets[e]) - both):
                low, high = sorted((top(d), top(e)))
                above[high] = low
    return {d: (len(s), top(d)) for d, s in sets.items()}


def same(result, rows, size):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in result.collect()}
    want = brute(rows, size)
    assert {d: (got[d], want[d]) for d in want if got[d] != want[d]} == {} and got.keys() == want.keys()
    return want


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query(spark, sf):
    path = f"/root/testdata/sf{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    want = same(op8_near_duplicates(spark, path), rows, 4)
    assert len({c for _, c in want.values()}) < len(want)


def edited(rng, words, share):
    return [rng.choice(["alpha", "beta", "gamma"]) + str(rng.random()) if rng.random() < share else w for w in words]


def test_hot_groups(spark, monkeypatch):
    """A passage in many documents and a large group of near copies, above the size of a hot list."""
    monkeypatch.setattr(neardup, "HOT", 4)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base, passage = [word() for _ in range(150)], [word() for _ in range(80)]
    texts = [" ".join(edited(rng, base, 0.03)) for _ in range(60)]
    texts += [" ".join(edited(rng, base, 0.06)) for _ in range(40)]
    texts += [" ".join([word() for _ in range(n)] + passage) for n in (0, 3, 5, 10, 20, 40, 60, 80, 150) for _ in range(6)]
    texts += [" ".join(passage[:-n]) for n in range(1, 30)] + [" ".join(base)] * 20
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    documents = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as class", "1 as value", "2 as n")
    for size in (4, 5):
        same(neardup.near_duplicates(documents, size), rows, size)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (9, "a  B"), (None, "a b"), (6, "x"), (6, "X"), (7, "long " * 40000), (8, "é É"), (10, "é é")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, neardup.near_duplicates(documents).collect()), key=str)
    assert got == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (9, 1, 4, False), (None, 1, None, True),
        (6, 1, 6, True), (6, 1, 6, True), (7, 1, 7, True), (8, 1, 8, True), (10, 1, 10, True),
    ], key=str)
    assert sorted(r.doc_id for r in neardup.one_of_each(documents).collect() if r.doc_id) == [1, 2, 3, 4, 6, 6, 7, 8, 10]


def test_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 202), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 0, 200: 200, 201: 200, 202: 200}


@pytest.mark.parametrize("own, most", [(200, 0), (40, 123 * 14)])
def test_pages_of_one_template(spark, monkeypatch, own, most):
    """A common template and own words: pages that cannot be alike are not compared; those that are, are found."""
    monkeypatch.setattr(neardup, "HOT", 8)
    seen, plain = [], neardup._block_links

    def counted(rows, sets):
        n = {(r.apart, r.shares): r["count"] for r in rows.groupBy("apart", "shares").count().collect()}
        sharing = n.get((True, True), 0) + n.get((False, True), 0)
        seen.append(n.get((True, True), 0) * sum(n.values()) + n.get((True, False), 0) * sharing)
        return plain(rows, sets)

    monkeypatch.setattr(neardup, "_block_links", counted)
    rng = random.Random(own)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    template = [word() for _ in range(300)]
    pages = [template[:150] + [word() for _ in range(own)] + template[150:] for _ in range(120)]
    pages += [edited(rng, pages[n], 0.01) for n in (3, 50, 77)]
    rows = list(enumerate(" ".join(p) for p in pages))
    want = same(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5), rows, 5)
    assert all(want[120 + i][1] == want[n][1] for i, n in enumerate((3, 50, 77)))
    assert len(seen) == 1 and seen[0] <= most
