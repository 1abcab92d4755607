"""Decontamination against plain windows; more shards than one."""

import random
import re

import pytest

from adtally.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, size=10):
    windows = [(i, tuple(w[a:a + size])) for i, t in items if i is not None for w in [words(t)] if w for a in range(max(1, len(w) - size + 1))]
    result = {}
    for d, t in texts:
        w = words(t)
        hits = [(i, a, len(x)) for i, x in windows for a in range(len(w) - len(x) + 1) if tuple(w[a:a + len(x)]) == x]
        result[d] = (len(w), sorted({p for _, a, n in hits for p in range(a, a + n)}), sorted({str(i) for i, _, _ in hits}))
    return result


@pytest.mark.parametrize("shard_chars", [10_000_000, 300])
def test_against_windows(spark, shard_chars):
    rng = random.Random(4)
    vocabulary = ["a", "B", "é", "Éb", "12", "x_y", "don't", "—", "\x00z", "漢字"]
    make = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(n, make(rng.randint(0, 30))) for n in range(12)] + [(12, None), (13, ""), (None, "a B"), (3, "12 12"), (14, "漢字"), (15, "q " * 12)]
    texts = [(n, make(rng.randint(0, 60))) for n in range(60)] + [(60, None), (61, ""), (62, items[5][1]), (63, "w " * 9 + items[2][1] + " w"), (64, "Q " * 3000)]
    documents = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 as items", "2 as hits", "3 as row")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts, items)
    got = decontam.contamination(documents, benchmark, shard_chars=shard_chars).collect()
    assert {r.doc_id: (r.n_words, [h.word for h in r.hits], list(r["items"])) for r in got} == want and len(got) == len(texts)
    text = dict(texts)
    for r in got:
        for h in r.hits:
            assert words(text[r.doc_id][h.start:h.end]) == [words(text[r.doc_id])[h.word]]
    kept = decontam.clean_documents(documents, benchmark, shard_chars=shard_chars)
    assert {r.doc_id for r in kept.collect()} == {d for d, (_, hit, _) in want.items() if not hit} and kept.columns == documents.columns


def test_empty_tables(spark):
    documents = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.n_hit) for r in decontam.contamination_report(documents, items).collect()) == [(0, 0), (1, 2), (1, 2)]
    assert {r.n_hit for r in decontam.contamination_report(documents, items.limit(0)).collect()} == {0}
    assert decontam.contamination_report(documents.limit(0), items).collect() == []
