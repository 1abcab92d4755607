"""The token store: ids as the tokenizer gives them, every key found by its hash, nothing else."""

import glob
import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adtally.llm import packing, tokenstore
from adtally.llm.queries import op13_token_store
from adtally.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(tokenizer, rows):
    """(doc_id, start, n_tokens, crc32) of (doc_id, text) rows that are in order."""
    found, at = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        found.append((doc_id, at, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        at += len(ids)
    return found


def test_query(spark, tokenizer):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in op13_token_store(spark, SF).collect())
    assert got == expected(tokenizer, sorted(map(tuple, rows)))


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 10 ** 6))
def test_hash_function_is_minimal_and_perfect(n, seed):
    rng = np.random.default_rng(seed)
    one, two = rng.integers(0, 1 << 63, n).astype(np.uint64), rng.integers(0, 1 << 63, n).astype(np.uint64)
    one[:n // 3] = 7  # equal first hashes are told apart by the second
    function = tokenstore.HashFunction.of(one, two)
    assert sorted(function(one, two)) == list(range(n))
    rows = np.zeros(n, tokenstore.ROW)
    rows["fingerprint"][function(one, two)] = two
    again, table = tokenstore.read_bucket(tokenstore.bucket_bytes(function, rows))
    assert (again(one, two) == function(one, two)).all() and (table == rows).all()
    other = rng.integers(0, 1 << 63, 100).astype(np.uint64)
    number = again(other, other)
    assert ((number >= -1) & (number < max(n, 1))).all()
    assert len(function.bits) * 8 <= 6 * n + 200


def test_equal_hashes_are_refused():
    one = np.array([5, 5, 6], np.uint64)
    with pytest.raises(ValueError):
        tokenstore.HashFunction.of(one, one)


def test_lookup_finds_what_is_there_and_nothing_else(spark, tokenizer):
    texts = [(f"key {i}", f"text number {i} " * (i % 7)) for i in range(500)]
    folder = scratch_path(spark, "store")
    tokenstore.write_store(spark.createDataFrame(texts, "name string, text string").repartition(5), folder, "name", shard_bytes=2000)
    assert len(glob.glob(f"{folder.removeprefix('file://')}/ids/*.ids")) > 5
    asked = spark.createDataFrame([("key 3",), ("key 3",), ("key 499",), ("absent",), (None,), ("key 0",)], "name string")
    rows = tokenstore.lookup(spark, folder, asked, "name").collect()
    want = {k: rest for k, *rest in expected(tokenizer, sorted(texts)) if k in ("key 0", "key 3", "key 499")}
    assert {r.name: [r.start, r.n_tokens, r.ids_crc32] for r in rows} == want and len(rows) == 3
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in rows)


def test_shards_hold_raw_ids(spark, tokenizer):
    texts = [(i, f"Some words, {i} of them") for i in range(40)]
    folder = scratch_path(spark, "store")
    tokenstore.write_store(spark.createDataFrame(texts, "doc_id long, text string"), folder, shard_bytes=100)
    files = sorted(glob.glob(f"{folder.removeprefix('file://')}/ids/*.ids"))
    ids = np.concatenate([np.fromfile(f, "<u2") for f in files])
    assert ids.tolist() == list(itertools.chain(*([*tokenizer.encode(t, add_special_tokens=False).ids, 1] for _, t in texts)))


def test_repeated_keys_over_many_shards(spark, tokenizer):
    """One key holds most rows, with equal and different texts; a null key; odd texts; clashing columns."""
    rows = [(5, "the same words again")] * 300 + [(5, f"other {i}") for i in range(100)] + [(None, "no id"), (None, None)]
    rows += [(1, None), (2, ""), (9, "x" * 20000), (7, "<|startoftext|> a\"\"b\n\t ")]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "'z' as row", "2 as shard", "3 as one")
    folder = scratch_path(spark, "store")
    tokenstore.write_store(table.repartition(7), folder, shard_bytes=1000)
    got = tokenstore.lookup(spark, folder, table.select("doc_id"), ids=False).collect()
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(expected(tokenizer, [(doc_id, text)])[0][2:])
    found, at = {}, 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        found.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert list(found) == [None, 1, 2, 5, 7, 9]
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in texts.items()}


def test_words_of_a_batch_are_encoded_together(tokenizer, monkeypatch):
    """The same ids whether a word is remembered, new in the batch, or beyond what is remembered."""
    monkeypatch.setattr(tokenstore, "REMEMBERED_PARTS", 5)
    monkeypatch.setattr(packing, "REMEMBERED_PARTS", 5)
    monkeypatch.setattr(tokenstore, "REMEMBERED", 6)
    vocabulary = tokenstore.Vocabulary(tokenizer)
    texts = ["Plain words, and MORE words.", None, "", "naïve größe straßenbahn don't stop", "a\n\nb words. 12 <x> \x85 ½", "new again, plain"]
    for some in (texts, texts[::-1], [], [None]):
        got = [np.frombuffer(b, "<u2").tolist() for b in vocabulary.documents(some, 1)]
        assert got == [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in some]
    assert len(vocabulary.parts) <= 6


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokenstore.store_report(empty).collect() == []
    folder = scratch_path(spark, "store")
    tokenstore.write_store(empty, folder)
    assert tokenstore.lookup(spark, folder, spark.range(3).withColumnRenamed("id", "doc_id")).collect() == []
